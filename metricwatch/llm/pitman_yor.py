"""A hierarchical Pitman-Yor language model of words, learnt and applied as Spark jobs.

Each preceding word is a context restaurant; all of them share one parent restaurant, whose base is uniform over the
known words and one unknown. A customer of a context restaurant who opens a table is a customer of the parent. The
probability of w after u is (c_uw - d t_uw + (theta + d t_u) P(w)) / (theta + c_u), with c customers and t tables.

Seating is sampled by Gibbs: all customers of a word in a restaurant get up and are seated again by the Chinese-restaurant rule,
the others staying where they are. Within a round, restaurants see the parent's probabilities as of the round before, and halves of
each restaurant's words take turns. Predictive terms are averaged over the rounds after the first.

Counts never pass through the driver. Tasks aggregate what they hold, and send packed arrays by bucket: pairs to buckets by
context, words to buckets by word. Contexts with a large share of all tokens, of which there are at most two per bucket,
are split further by word. A pair that occurred once has one customer at one table and needs no sampling, so it is
only kept if the scoring of held-out documents needs it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricwatch.llm.blocks import dealt, joined
from metricwatch.llm.shared import partitions, remainder, stored
from metricwatch.llm.text import gather, mix, slices, words

#: Every text ends with this token, which also stands before its first word.
END = np.uint64(0x2545F4914F6CDD1D)
#: Ids with this remainder are held out of learning.
FOLDS, HELD_OUT = 7, 2
#: Rounds of sampling, of which the first isn't averaged, and reseatings of each word within one.
ROUNDS, SWEEPS = 3, 2
STRENGTH = 1.0
#: Documents are scored in so many passes, so that the pairs of one pass are on the move at a time.
PASSES = 3
#: Buckets of pairs for each bucket of words, which are fewer: the blocks sent between them are their product.
PAIRS_PER_WORDS = 6
#: Tokens of a task that are aggregated at once, and documents at most: their numbers take 15 bits.
CHUNK_TOKENS, CHUNK_DOCS = 1_000_000, 30_000
#: Text hashed at a time: numpy's arrays of so many bytes stay in the processor's cache.
HASHED_BYTES = 512 << 10

_BLOCK = "kind int, bucket int, source long, a binary, b binary, c binary, d binary, e binary, f binary, g binary, h binary"
_FIELDS = "abcdefgh"
_MESSAGE, _ROOT, _STATIC, _SEATS, _REPLY, _CHUNK, _DOCS, _TOTAL, _HOT = range(9)


def _rows(kind: int, rows: list[tuple]) -> pa.RecordBatch:
    """Rows of _BLOCK from (bucket, source, array, array, ...)."""
    wide = [(*r, *[None] * (2 + len(_FIELDS) - len(r))) for r in rows]
    arrays = [pa.array([kind] * len(rows), pa.int32()), pa.array([int(r[0]) for r in wide], pa.int32()), pa.array([int(r[1]) for r in wide], pa.int64())]
    for k in range(len(_FIELDS)):
        arrays.append(pa.array([None if r[2 + k] is None else r[2 + k].tobytes() for r in wide], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, ["kind", "bucket", "source", *_FIELDS])


def _of(group: pa.Table, kind: int) -> list[dict]:
    return [r for r in group.filter(pc.equal(group.column("kind"), kind)).sort_by("source").to_pylist()]


def _get(row: dict, name: str, dtype: str) -> np.ndarray:
    return np.frombuffer(row[name] or b"", dtype)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids of documents, whether each is held out, and of every token: the token before it, itself, its document's number."""
    ids, held, tokens, owners, n_docs, n_tokens = [], [], [], [], 0, 0

    def done():
        w = np.concatenate(tokens)
        return pa.concat_arrays(ids), np.concatenate(held), np.concatenate([[END], w[:-1]]).astype(np.uint64), w, np.concatenate(owners)

    for batch in batches:
        for at, texts in slices(batch.column("text"), HASHED_BYTES):
            hashes, starts = words(texts)
            n = np.diff(starts) + 1
            w = np.full(int(n.sum()), END, np.uint64)
            w[gather(np.cumsum(n) - n, n - 1)] = hashes
            if n_docs and (n_tokens + len(w) > CHUNK_TOKENS or n_docs + len(n) > CHUNK_DOCS):
                yield done()
                ids, held, tokens, owners, n_docs, n_tokens = [], [], [], [], 0, 0
            ids.append(batch.column("doc_id").slice(at, len(n)))
            held.append(batch.column("held").slice(at, len(n)).to_numpy(zero_copy_only=False))
            tokens.append(w)
            owners.append(np.repeat(np.arange(n_docs, n_docs + len(n)), n))
            n_docs, n_tokens = n_docs + len(n), n_tokens + len(w)
    if n_docs:
        yield done()


def seated(customers: np.ndarray, others: np.ndarray, parent: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables after seating `customers` one after another, with `others` tables standing already for other words.

    Beyond the first few, an eighth as many as sit are seated at once, each by the rule as it stands.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    sitting = tables.copy()
    active = np.flatnonzero(sitting < customers)
    while len(active):
        sit, t, p = sitting[active], tables[active], parent[active]
        group = np.minimum(np.maximum(sit // 8, 1), customers[active] - sit)
        new = (STRENGTH + discount * (others[active] + t)) * p
        tables[active] += rng.binomial(group, new / (new + sit - discount * t))
        sitting[active] += group
        active = active[sitting[active] < customers[active]]
    return tables


class Model:
    """A fitted model: stored blocks of counts and seatings, and a few totals."""

    def __init__(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"):
        """Learns from documents whose id isn't held out by remainder(); ids that are null are learnt from."""
        self.buckets = n = partitions(docs.sparkSession)
        self.roots = max(2, n // PAIRS_PER_WORDS)
        held = F.coalesce(remainder(id_column, FOLDS) == HELD_OUT, F.lit(False))
        text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
        self.docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), held.alias("held"), text.alias("text"))
        self.words = stored(self.docs.filter("NOT held").mapInArrow(_count_words(self.roots), _BLOCK).groupBy("bucket").applyInArrow(_sum_words, _WORDS))
        sums = self.words.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "types", "ones", "twos"))).first()
        self.tokens, self.types = int(sums[0]), int(sums[1])
        self.root_discount = _discount(sums[2], sums[3])
        # Contexts with more than half a bucket's share: at most two per bucket.
        share = max(1, self.tokens // (2 * n))
        often = self.words.mapInArrow(_often(share), "word long, n long").collect() if self.tokens else []
        self.hot = {r["word"] & (2**64 - 1): (r["n"], min(n, -(-r["n"] // share))) for r in often}
        pairs = self.docs.mapInArrow(_count_pairs(n, self.hot), _BLOCK)
        self.static = stored(pairs.groupBy("bucket").applyInArrow(_sum_pairs(self.roots, self.hot), _BLOCK + ", ones long, twos long"))
        sums = self.static.agg(F.coalesce(F.sum("ones"), F.lit(0)), F.coalesce(F.sum("twos"), F.lit(0))).first()
        self.static = self.static.drop("ones", "twos")
        self.discount = _discount(sums[0], sums[1])
        self._sample()

    def _sample(self) -> None:
        roots = self.words.selectExpr(f"{_ROOT} AS kind", "bucket", "0L AS source", "keys AS a", "counts AS b", *(f"CAST(NULL AS BINARY) AS {x}" for x in "cdefgh"))
        settings = (self.tokens, self.types, self.root_discount, self.discount)
        static = self.static.withColumn("h", F.lit(None).cast("binary"))  # words that only scoring needs
        seats, root, totals = None, roots, (float(self.tokens), float(self.types))
        hot = {u: c for u, (c, _) in self.hot.items()}
        hot_tables: dict[int, float] = {}
        for number in range(ROUNDS):
            known = static if seats is None else static.unionByName(seats)
            sent = known.groupBy("bucket").applyInArrow(_send_tables(self.roots), _BLOCK)
            found = sent.unionByName(root).groupBy("bucket").applyInArrow(_seat_root(settings, totals, number), _BLOCK)
            found = stored(found)
            root = found.filter(F.col("kind") == _ROOT)
            parts = [np.frombuffer(r["a"], np.float64) for r in found.filter(F.col("kind") == _TOTAL).select("a").collect()]
            totals = tuple(np.sum(parts, axis=0).tolist()) if parts else (0.0, 0.0)
            replies = found.filter(F.col("kind") == _REPLY)
            moved = known.unionByName(replies).groupBy("bucket").applyInArrow(_seat_contexts(settings, totals, number, hot, hot_tables), _BLOCK)
            moved = stored(moved)
            seats = moved.filter(F.col("kind") == _SEATS)
            hot_tables = {}
            for r in moved.filter(F.col("kind") == _HOT).select("a", "b", "c").collect():  # at most four per bucket
                for u, t, s in zip(*(np.frombuffer(r[k], d).tolist() for k, d in (("a", "<u8"), ("b", "<i8"), ("c", "<i8"))), strict=True):
                    a, b = hot_tables.get(u, (0, 0))
                    hot_tables[u] = (a + t, b + s)
        self.seats, self.root, self.totals, self.hot_tables = seats, root, totals, hot_tables

    def scores(self) -> DataFrame:
        """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document; see op3's contract."""
        n, settings = self.buckets, (self.tokens, self.types, self.root_discount, self.discount)
        asked = self.static.select("kind", "bucket", "source", "h").mapInArrow(_ask_words(self.roots), _BLOCK)
        replies = stored(asked.unionByName(self.root).groupBy("bucket").applyInArrow(_tell_words(settings, self.totals), _BLOCK))
        known = self.static.unionByName(self.seats).unionByName(replies)
        hot = {u: (self.hot[u][0], *self.hot_tables.get(u, (0, 0))) for u in self.hot}
        parts = []
        for number in range(PASSES):
            docs = self.docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(PASSES)) == number)
            met = known.unionByName(docs.mapInArrow(_occurrences(n, self.hot), _BLOCK))
            sums = met.groupBy("bucket").applyInArrow(_score_pairs(settings, hot), _BLOCK)
            parts.append(stored(sums.groupBy("source").applyInArrow(_score_documents, _SCORES)))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out.withColumn("train_tokens", F.lit(self.tokens).cast("long"))


_WORDS = "bucket int, keys binary, counts binary, tokens long, types long, ones long, twos long"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _discount(ones: int, twos: int) -> float:
    """From how many kinds were met once and twice."""
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones or twos else 0.5


def _seed(*numbers: int) -> np.random.Generator:
    return np.random.default_rng([int(x) for x in numbers])


def _sum_by(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of their values."""
    if not len(keys):
        return keys, *values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[heads], *(np.add.reduceat(v[order], heads) for v in values)


# Words


def _count_words(n: int):
    def rows(batches):
        for _, _, _, w, _ in _chunks(batches):
            keys, counts = np.unique(w, return_counts=True)
            order, begins = dealt((keys % np.uint64(n)).astype(np.int64), n)
            keys, counts = keys[order], counts[order].astype("<i8")
            yield _rows(_MESSAGE, [(i, 0, keys[begins[i] : begins[i + 1]], counts[begins[i] : begins[i + 1]]) for i in np.flatnonzero(np.diff(begins))])

    return rows


def _sum_words(key: tuple, group: pa.Table) -> pa.Table:
    keys, counts = _sum_by(joined(group.column("a"), "<u8"), joined(group.column("b"), "<i8"))
    values = [key[0].as_py(), keys.tobytes(), counts.tobytes(), int(counts.sum()), len(keys), int((counts == 1).sum()), int((counts == 2).sum())]
    kinds = [pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
    return pa.Table.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], ["bucket", "keys", "counts", "tokens", "types", "ones", "twos"])


def _often(share: int):
    def rows(batches):
        for batch in batches:
            keys = np.concatenate([np.frombuffer(x.as_buffer(), "<u8") for x in batch.column("keys")])
            counts = np.concatenate([np.frombuffer(x.as_buffer(), "<i8") for x in batch.column("counts")])
            yield pa.RecordBatch.from_arrays([pa.array(keys[counts > share].view(np.int64)), pa.array(counts[counts > share])], ["word", "n"])

    return rows


# Pairs


def _home(u: np.ndarray, w: np.ndarray, n: int, hot: dict) -> np.ndarray:
    """The bucket of each pair: that of its context, or one of several for a context with many tokens."""
    key = u.copy()
    if hot:
        names = np.array(sorted(hot), np.uint64)
        at = np.minimum(np.searchsorted(names, u), len(names) - 1)
        is_hot = names[at] == u
        parts = np.array([hot[int(x)][1] for x in names], np.uint64)[at[is_hot]]
        key[is_hot] += (mix(w[is_hot]) % parts) * np.uint64(0xA0761D6478BD642F)
    return (mix(key) % np.uint64(n)).astype(np.int64)


def _pair(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(u * np.uint64(3) + mix(w))


def _distinct_pairs(u: np.ndarray, w: np.ndarray, n: int, hot: dict):
    """Distinct pairs ordered by bucket and context, where each bucket starts, and the place of every token's pair there."""
    _, where, back = np.unique(_pair(u, w), return_index=True, return_inverse=True)
    u, w = u[where], w[where]
    bucket = _home(u, w, n, hot)
    order = np.argsort(u, kind="stable")
    later, begins = dealt(bucket[order], n)
    order = order[later]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return u[order], w[order], begins, place[back]


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of runs of equal numbers, and their lengths."""
    heads = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    return x[heads], np.diff(np.append(heads, len(x))).astype("<u4")


def _count_pairs(n: int, hot: dict):
    def rows(batches):
        for _, held, u, w, owner in _chunks(batches):
            learnt = ~held[owner]
            u, w, begins, place = _distinct_pairs(u, w, n, hot)
            counts = np.bincount(place, weights=learnt, minlength=len(u)).astype("<u4")
            heard = np.bincount(place, weights=~learnt, minlength=len(u)).astype(bool).astype("u1")
            out = []
            for i in np.flatnonzero(np.diff(begins)):
                part = slice(begins[i], begins[i + 1])
                out.append((i, 0, *_runs(u[part]), w[part], counts[part], heard[part]))
            yield _rows(_MESSAGE, out)

    return rows


def _sum_pairs(roots: int, hot: dict):
    """Static block of a bucket: contexts a, their customers b, pairs met once and not kept c; kept pairs by context
    number d, word number e and count f; the words of kept pairs g, and all words h, both by word bucket."""

    def rows(key, group):
        u = np.repeat(joined(group.column("a"), "<u8"), joined(group.column("b"), "<u4"))
        w, counts, heard = joined(group.column("c"), "<u8"), joined(group.column("d"), "<u4").astype(np.int64), joined(group.column("e"), "u1")
        order = np.lexsort((w, u))
        u, w = u[order], w[order]
        heads = np.flatnonzero(np.concatenate([[True], (u[1:] != u[:-1]) | (w[1:] != w[:-1])])) if len(u) else np.zeros(0, np.int64)
        counts, heard = np.add.reduceat(counts[order], heads), np.maximum.reduceat(heard[order], heads)
        u, w = u[heads], w[heads]
        contexts, number = np.unique(u, return_inverse=True)
        customers = np.bincount(number, weights=counts, minlength=len(contexts)).astype("<i8")
        for i in np.flatnonzero(np.isin(contexts, np.array(sorted(hot), np.uint64))) if hot else ():
            customers[i] = hot[int(contexts[i])][0]
        keep = (counts > 1) | (counts == 1) & (heard == 1)
        alone = np.bincount(number, weights=(counts == 1) & ~keep, minlength=len(contexts)).astype("<i8")

        def by_home(values):
            values = np.unique(values)
            return values[np.argsort((values % np.uint64(roots)).astype(np.int64), kind="stable")]

        kept, every = by_home(w[keep]), by_home(w)
        sorted_kept = np.argsort(kept)
        at = sorted_kept[np.searchsorted(kept, w[keep], sorter=sorted_kept)] if len(kept) else np.zeros(0, np.int64)
        arrays = (contexts, customers, alone, number[keep].astype("<u4"), at.astype("<u4"), counts[keep].astype("<i8"), kept, every)
        batch = _rows(_STATIC, [(key[0].as_py(), 0, *arrays)])
        ones, twos = (pa.array([int((counts == k).sum())], pa.int64()) for k in (1, 2))
        return pa.Table.from_batches([batch]).append_column("ones", ones).append_column("twos", twos)

    return rows


# Sampling


def _state(group: pa.Table) -> tuple[dict | None, np.ndarray, np.ndarray, np.ndarray]:
    """The static block, tables of kept pairs now and summed over samples, and summed tables of contexts."""
    static = next(iter(_of(group, _STATIC)), None)
    if static is None:
        return None, *[np.zeros(0, np.int64)] * 3
    seats = next(iter(_of(group, _SEATS)), None)
    if seats is None:
        kept = len(_get(static, "d", "<u4"))
        return static, np.ones(kept, np.int64), np.zeros(kept, np.int64), np.zeros(len(_get(static, "a", "<u8")), np.int64)
    return static, _get(seats, "a", "<i8"), _get(seats, "b", "<i8"), _get(seats, "c", "<i8")


def _empty() -> pa.Table:
    return pa.Table.from_batches([_rows(0, [])])


def _send_tables(n: int):
    """To each word bucket: the words of kept pairs, and the customers and tables these have here."""

    def rows(key, group):
        static, tables, _, _ = _state(group)
        if static is None:
            return _empty()
        words_, at = _get(static, "g", "<u8"), _get(static, "e", "<u4")
        customers = np.bincount(at, weights=_get(static, "f", "<i8"), minlength=len(words_)).astype("<i8")
        tables = np.bincount(at, weights=tables, minlength=len(words_)).astype("<i8")
        begins = np.searchsorted((words_ % np.uint64(n)).astype(np.int64), np.arange(n + 1))
        out = [
            (i, key[0].as_py(), *(x[begins[i] : begins[i + 1]] for x in (words_, customers, tables))) for i in np.flatnonzero(np.diff(begins))
        ]
        return pa.Table.from_batches([_rows(_MESSAGE, out)])

    return rows


def _root_probability(m: np.ndarray, tables: np.ndarray, settings: tuple, totals: tuple) -> np.ndarray:
    _, types, discount, _ = settings
    customers, all_tables = totals
    return (np.maximum(m - discount * tables, 0) + (STRENGTH + discount * all_tables) / (types + 1)) / (STRENGTH + customers)


def _root_state(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a bucket, their counts, their customers and tables in the parent restaurant, summed probabilities."""
    root = next(iter(_of(group, _ROOT)), None)
    if root is None:
        return tuple(np.zeros(0, d) for d in ("<u8", "<i8", "<i8", "<i8", "<f8"))
    keys, counts = _get(root, "a", "<u8"), _get(root, "b", "<i8")
    if root["c"] is None:
        return keys, counts, counts, np.ones(len(keys), np.int64), np.zeros(len(keys))
    return keys, counts, _get(root, "c", "<i8"), _get(root, "d", "<i8"), _get(root, "e", "<f8")


def _seat_root(settings: tuple, totals: tuple, number: int):
    """The parent restaurant's share of words: customers are the tables of all contexts, seated anew."""

    def rows(key, group):
        bucket = key[0].as_py()
        keys, counts, m, tables, summed = _root_state(group)
        if number > 1:  # the round before counts, now that its totals are known
            summed = summed + _root_probability(m, tables, settings, totals)
        messages = _of(group, _MESSAGE)
        change = np.zeros(len(keys), np.int64)
        places = []
        for r in messages:
            at = np.searchsorted(keys, _get(r, "a", "<u8"))
            places.append(at)
            change[at] += _get(r, "c", "<i8") - _get(r, "b", "<i8")
        m = counts + change
        _, types, discount, _ = settings
        others = np.maximum(totals[1] - tables, 0)
        tables = seated(m, others, np.full(len(keys), 1 / (types + 1)), discount, _seed(11, number, bucket))
        out = [_rows(_ROOT, [(bucket, 0, keys, counts, m, tables, summed)])]
        out.append(_rows(_TOTAL, [(bucket, 0, np.array([m.sum(), tables.sum()], np.float64))]))
        out.append(_rows(_REPLY, [(r["source"], bucket, m[at], tables[at]) for r, at in zip(messages, places, strict=True)]))
        return pa.Table.from_batches(out)

    return rows


def _seat_contexts(settings: tuple, totals: tuple, number: int, hot: dict, hot_tables: dict):
    """The restaurants of a bucket: all words of kept pairs are seated anew."""

    def rows(key, group):
        static, tables, summed, context_sum = _state(group)
        if static is None:
            return _empty()
        replies = _of(group, _REPLY)
        m = np.concatenate([np.zeros(0, np.int64), *(_get(r, "a", "<i8") for r in replies)])
        root_tables = np.concatenate([np.zeros(0, np.int64), *(_get(r, "b", "<i8") for r in replies)])
        context, at, customers = _get(static, "d", "<u4"), _get(static, "e", "<u4"), _get(static, "f", "<i8")
        parent = _root_probability(m, root_tables, settings, totals)[at]
        names, alone = _get(static, "a", "<u8"), _get(static, "c", "<i8")
        split = np.flatnonzero(np.isin(names, np.array(sorted(hot), np.uint64))) if hot else np.zeros(0, np.int64)

        def context_tables(tables):
            return alone + np.bincount(context, weights=tables, minlength=len(names)).astype(np.int64)

        # What a split context has in other buckets, as of the last round.
        elsewhere = np.zeros(len(names), np.int64)
        own = context_tables(tables)
        for i in split.tolist():
            elsewhere[i] = max(0, hot_tables.get(int(names[i]), (own[i], 0))[0] - own[i])
        rng, tables = _seed(13, number, key[0].as_py()), tables.copy()
        for _ in range(SWEEPS):
            side = rng.integers(0, 2, len(tables))
            for half in (0, 1):
                turn = side == half
                others = (context_tables(tables) + elsewhere)[context[turn]] - tables[turn]
                tables[turn] = seated(customers[turn], others, parent[turn], settings[3], rng)
        own = context_tables(tables)
        if number:
            summed, context_sum = summed + tables, context_sum + own
        out = [_rows(_SEATS, [(key[0].as_py(), 0, tables.astype("<i8"), summed.astype("<i8"), context_sum.astype("<i8"))])]
        if len(split):
            out.append(_rows(_HOT, [(key[0].as_py(), 0, names[split], own[split].astype("<i8"), context_sum[split].astype("<i8"))]))
        return pa.Table.from_batches(out)

    return rows


# Scoring


def _ask_words(n: int):
    def rows(batches):
        for batch in batches:
            for r in batch.to_pylist():
                words_ = _get(r, "h", "<u8")
                begins = np.searchsorted((words_ % np.uint64(n)).astype(np.int64), np.arange(n + 1))
                yield _rows(_MESSAGE, [(i, r["bucket"], words_[begins[i] : begins[i + 1]]) for i in np.flatnonzero(np.diff(begins))])

    return rows


def _tell_words(settings: tuple, totals: tuple):
    """To each bucket that asked: the averaged parent probability of its words, and their counts."""

    def rows(key, group):
        keys, counts, m, tables, summed = _root_state(group)
        average = (summed + _root_probability(m, tables, settings, totals)) / max(1, ROUNDS - 1)
        unknown = _root_probability(np.zeros(1), np.zeros(1), settings, totals)[0]
        out = []
        for r in _of(group, _MESSAGE):
            asked = _get(r, "a", "<u8")
            at = np.minimum(np.searchsorted(keys, asked), max(0, len(keys) - 1))
            known = keys[at] == asked if len(keys) else np.zeros(len(asked), bool)
            p, c = np.full(len(asked), unknown, "<f4"), np.zeros(len(asked), "<i8")
            p[known], c[known] = average[at[known]], counts[at[known]]
            out.append((r["source"], key[0].as_py(), p, c))
        return pa.Table.from_batches([_rows(_REPLY, out)])

    return rows


def _occurrences(n: int, hot: dict):
    """Chunks of documents as distinct pairs per bucket, each with the documents it occurs in; and the documents' ids."""

    def rows(batches):
        for number, (ids, held, u, w, owner) in enumerate(_chunks(batches)):
            chunk = TaskContext.get().partitionId() << 24 | number
            u, w, begins, place = _distinct_pairs(u, w, n, hot)
            order = np.argsort(place, kind="stable")
            times = np.bincount(place, minlength=len(u)).astype("<u4")
            docs = (owner | held[owner].astype(np.int64) << 15)[order].astype("<u2")
            ends = np.concatenate([[0], np.cumsum(times, dtype=np.int64)])
            out = []
            for i in np.flatnonzero(np.diff(begins)):
                part = slice(begins[i], begins[i + 1])
                out.append((i, chunk, *_runs(u[part]), w[part], times[part], docs[ends[begins[i]] : ends[begins[i + 1]]]))
            yield _rows(_CHUNK, out)
            lengths = np.bincount(owner, minlength=len(ids)).astype("<i8")
            known = np.array(ids.is_valid()).astype("u1")
            numbers = ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
            yield _rows(_DOCS, [(chunk % n, chunk, numbers, known, held.astype("u1"), lengths)])

    return rows


def _score_pairs(settings: tuple, hot: dict):
    """Per chunk and bucket: the documents that have pairs there, with sums of model and base scores and known tokens."""
    tokens, types, _, discount = settings
    samples = max(1, ROUNDS - 1)

    def rows(key, group):
        static, _, summed, context_sum = _state(group)
        keep = group.filter(pc.equal(group.column("kind"), _DOCS))
        out = [keep] if len(keep) else []
        chunks = _of(group, _CHUNK)
        if static is None or not chunks:
            return pa.concat_tables(out) if out else _empty()
        contexts, customers = _get(static, "a", "<u8"), _get(static, "b", "<i8").astype(np.float64)
        tables = context_sum / samples
        for i in np.flatnonzero(np.isin(contexts, np.array(sorted(hot), np.uint64))) if hot else ():
            tables[i] = hot[int(contexts[i])][2] / samples
        pass_on = (STRENGTH + discount * tables) / (STRENGTH + customers)
        number, at = _get(static, "d", "<u4"), _get(static, "e", "<u4")
        kept = _pair(contexts[number], _get(static, "g", "<u8")[at])
        direct = (_get(static, "f", "<i8") - discount * summed / samples) / (STRENGTH + customers[number])
        order = np.argsort(kept)
        kept, direct = kept[order], direct[order]
        words_, replies = _get(static, "h", "<u8"), _of(group, _REPLY)
        parent = np.concatenate([_get(r, "a", "<f4") for r in replies]).astype(np.float64)
        counts = np.concatenate([_get(r, "b", "<i8") for r in replies])
        order = np.argsort(words_)
        words_, parent, counts = words_[order], parent[order], counts[order]
        for r in chunks:
            u, w = np.repeat(_get(r, "a", "<u8"), _get(r, "b", "<u4")), _get(r, "c", "<u8")
            times, docs = _get(r, "d", "<u4"), _get(r, "e", "<u2")
            context, word = np.searchsorted(contexts, u), np.searchsorted(words_, w)
            pairs = _pair(u, w)
            place = np.minimum(np.searchsorted(kept, pairs), max(0, len(kept) - 1))
            found = kept[place] == pairs if len(kept) else np.zeros(len(pairs), bool)
            own = np.zeros(len(pairs))
            own[found] = direct[place[found]]
            once = np.where(found, own, (1 - discount) / (STRENGTH + customers[context]))  # in learnt documents
            rest = pass_on[context] * parent[word]
            held, doc = docs >> 15 == 1, docs & 0x7FFF
            score = np.where(held, np.repeat(np.log10(own + rest), times), np.repeat(np.log10(once + rest), times))
            base = np.repeat(np.log10((counts[word] + 1) / (tokens + types + 1)), times)
            known = np.repeat(counts[word] > 0, times)
            have, back = np.unique(doc, return_inverse=True)
            sums = [np.bincount(back, weights=x, minlength=len(have)) for x in (score, base, known)]
            batch = _rows(_CHUNK, [(key[0].as_py(), r["source"], have.astype("<u2"), sums[0], sums[1], sums[2].astype("<i8"))])
            out.append(pa.Table.from_batches([batch]))
        return pa.concat_tables(out)

    return rows


def _score_documents(key: tuple, group: pa.Table) -> pa.Table:
    docs = _of(group, _DOCS)[0]
    lengths = _get(docs, "d", "<i8")
    score, base, known = np.zeros(len(lengths)), np.zeros(len(lengths)), np.zeros(len(lengths), np.int64)
    for r in sorted(_of(group, _CHUNK), key=lambda r: r["bucket"]):
        have = _get(r, "a", "<u2")
        score[have] += _get(r, "b", "<f8")
        base[have] += _get(r, "c", "<f8")
        known[have] += _get(r, "d", "<i8")
    null = _get(docs, "b", "u1") == 0
    return pa.table(
        {
            "doc_id": pa.array(_get(docs, "a", "<i8"), pa.int64(), mask=null),
            "held_out": pa.array(_get(docs, "c", "u1").astype(bool)),
            "n_tokens": pa.array(lengths),
            "n_known": pa.array(known),
            "base_score": pa.array(base),
            "score": pa.array(score),
        }
    )


def perplexity(scores: DataFrame) -> DataFrame:
    """held_out, perplexity, base_perplexity: ten to the mean negative log10 probability of a token."""
    mean = [F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens")).alias(name) for c, name in (("score", "perplexity"), ("base_score", "base_perplexity"))]
    return scores.groupBy("held_out").agg(*mean)
