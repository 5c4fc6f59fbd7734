"""Groups of near copies: an exact Jaccard join on word shingles, by T-occurrence search.

Two documents link when 100 * |intersection| >= PERCENT * |union| of their shingle sets, so a document of n shingles
shares at least T = ceil(PERCENT * n / 100) of them with a document it links with.

1. Documents with the same set form a class, found by the set's 128-bit fingerprint; the class is represented by its
   least doc_id, and its members need no pairs.
2. Each task sends the sets it holds, as packed 32-bit keys per bucket; the bucket counts which keys more than one
   set has and sends each document its number of such keys. Documents with fewer than T of them link with nothing.
3. Of the rest, those that share one of their n - T + 1 least hashes (of which linked documents share one) are tied into
   neighbourhoods, which are searched each on its own; one with many documents is searched as pairs of blocks.
4. Within a block an inverted list per shingle is searched with DivideSkip: the longest lists are put aside, the short
   ones merged, and what occurs in them often enough is looked up in the long ones by binary search. Each
   block returns a spanning forest of the links it found, not the links.
5. Components of these forests, by joins, give each class its component; the least doc_id there is every member's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricwatch.llm.blocks import by_bucket, dealt, joined, rows_of
from metricwatch.llm.components import components
from metricwatch.llm.shared import frugal, frugal_group, partitions, stored
from metricwatch.llm.text import gather, mix, shingles, slices

PERCENT = 75
#: Documents of one neighbourhood that a task searches at once; more are searched as pairs of such blocks.
BLOCK_DOCS = 2_000
#: Keys of a bucket, and sets of a batch, that are looked up or dealt out at a time.
KEYS_AT_ONCE, SETS_AT_ONCE = 1 << 18, 1_000
#: Weight of a binary probe against a step of the merge in DivideSkip's choice of how many lists count as long.
PROBE_COST = 0.01


def threshold(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Shingles that a document of n shingles has in common with any that it links with, at least."""
    return -(-n * percent // 100)


def _fingerprints(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set."""
    out = []
    for salt in (0, 0x5851F42D4C957F2D):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(salt)), dtype=np.uint64)])
        out.append((sums[starts[1:]] - sums[starts[:-1]]).view(np.int64))
    return out[0], out[1]


def _read(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))


def set_table(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Of every row: doc_id, n_shingles, and the fingerprint (a, b) of its shingle set."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column("text")):
                hashes, starts = shingles(texts)
                a, b = _fingerprints(hashes, starts)
                ids = batch.column("doc_id").slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(starts)), pa.array(a), pa.array(b)], ["doc_id", "n_shingles", "a", "b"])

    return _read(docs, id_column, text_column).mapInArrow(frugal(rows), "doc_id long, n_shingles long, a long, b long")


def _repeated(keys: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many keys of each run occur more than once among all; no run is empty."""
    ordered = np.sort(keys)
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    del ordered
    hit = np.zeros(len(keys), bool)
    for at in range(0, len(keys) if len(shared) else 0, KEYS_AT_ONCE):
        part = keys[at : at + KEYS_AT_ONCE]
        hit[at : at + KEYS_AT_ONCE] = shared[np.minimum(np.searchsorted(shared, part), len(shared) - 1)] == part
    return np.add.reduceat(hit, np.cumsum(lengths) - lengths, dtype=np.int64)


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most SETS_AT_ONCE rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, SETS_AT_ONCE):
            yield batch.slice(at, SETS_AT_ONCE)


def _shared_counts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """set_id, shared: how many shingles of a set (named by its fingerprint's first half) others have too, or more.

    Keys are 32 bits within a bucket, so a few more than the truly shared count; a task sends a set once. Sets without any are left out.
    """
    n = partitions(docs.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # sets of this task
        for batch in batches:
            for at, texts in slices(batch.column("text")):
                hashes, starts = shingles(texts)
                a, b = _fingerprints(hashes, starts)
                new = np.zeros(len(a), bool)
                for i, key in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
                    if key not in seen:
                        seen.add(key)
                        new[i] = True
                sizes = np.where(new, np.diff(starts), 0)
                hashes = hashes[gather(starts[:-1], sizes)]
                owner = np.repeat(np.arange(len(a)), sizes)
                bucket = (hashes % np.uint64(n)).astype(np.int64)
                order, begins = dealt(bucket, n)
                keys, owner = (hashes[order] >> np.uint64(32)).astype("<u4"), owner[order]
                edge = np.ones(len(owner), bool)
                edge[1:] = owner[1:] != owner[:-1]
                edge[begins[:-1][begins[:-1] < len(owner)]] = True
                runs = np.flatnonzero(edge)
                lengths = np.diff(np.append(runs, len(owner))).astype("<u4")
                run_ids = a[owner[runs]].astype("<i8")
                sent = by_bucket("bucket", begins, keys=keys)
                runs = by_bucket("bucket", np.searchsorted(runs, begins), ids=run_ids, lengths=lengths)
                yield pa.RecordBatch.from_arrays([*sent.columns, *runs.columns[1:]], ["bucket", "keys", "ids", "lengths"])

    def count(group: pa.Table) -> pa.Table:
        keys, ids, lengths = joined(group.column("keys"), "<u4"), joined(group.column("ids"), "<i8"), joined(group.column("lengths"), "<u4")
        counts = _repeated(keys, lengths.astype(np.int64))
        some = counts > 0
        ids, counts = ids[some], counts[some].astype("<u4")
        order, begins = dealt((mix(ids.view(np.uint64)) % np.uint64(n)).astype(np.int64), n)
        return pa.Table.from_batches([by_bucket("home", begins, ids=ids[order], counts=counts[order])])

    def total(group: pa.Table) -> pa.Table:
        ids, back = np.unique(joined(group.column("ids"), "<i8"), return_inverse=True)
        sums = np.bincount(back, weights=joined(group.column("counts"), "<u4"), minlength=len(ids))
        return pa.table({"set_id": pa.array(ids, pa.int64()), "shared": pa.array(sums.astype(np.int64))})

    sent = _read(docs, id_column, text_column).filter("doc_id IS NOT NULL").mapInArrow(frugal(send), "bucket int, keys binary, ids binary, lengths binary")
    back = sent.groupBy("bucket").applyInArrow(frugal_group(count), "home int, ids binary, counts binary")
    return back.groupBy("home").applyInArrow(frugal_group(total), "set_id long, shared long")


def _candidates(docs: DataFrame, chosen: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """set_id, n, keys (the sorted 64-bit hashes as bytes) of the sets in `chosen`, each once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column("text")):
                hashes, starts = shingles(texts)
                keys = [hashes[a:b].astype("<u8").tobytes() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                sets = pa.array(_fingerprints(hashes, starts)[0])
                yield pa.RecordBatch.from_arrays([sets, pa.array(np.diff(starts)), pa.array(keys, pa.binary())], ["set_id", "n", "keys"])

    wanted = chosen.select(F.col("rep").alias("doc_id")).distinct()
    read = _read(docs, id_column, text_column).join(wanted.hint("shuffle_hash"), "doc_id", "left_semi")
    found = read.mapInArrow(frugal(rows), "set_id long, n long, keys binary").dropDuplicates(["set_id"])
    return found.join(chosen.select(F.col("a").alias("set_id")), "set_id", "left_semi")


def _rare_first(sets: DataFrame, percent: int) -> DataFrame:
    """set_id, n, keys: those shingles that another of these documents has too, the rarest first; see _shared_counts().

    Documents that have fewer than T of them are left out.
    """
    n = partitions(sets.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            sizes = batch.column("n").to_numpy()
            hashes = np.frombuffer(b"".join(batch.column("keys").to_pylist()), "<u8")
            owner = np.repeat(np.arange(len(sizes)), sizes)
            order, begins = dealt((mix(hashes) % np.uint64(n)).astype(np.int64), n)
            hashes, ids = hashes[order], batch.column("set_id").to_numpy()[owner[order]].astype("<i8")
            yield by_bucket("bucket", begins, sizes=sizes[owner[order]].astype("<u4"), keys=hashes, ids=ids)

    def rarity(group: pa.Table) -> pa.Table:
        keys, ids, sizes = joined(group.column("keys"), "<u8"), joined(group.column("ids"), "<i8"), joined(group.column("sizes"), "<u4")
        _, back, count = np.unique(keys, return_inverse=True, return_counts=True)
        found = count[back]
        some = found > 1
        keys, ids, sizes, found = keys[some], ids[some], sizes[some], found[some].astype("<u4")
        order, begins = dealt((mix(ids.view(np.uint64)) % np.uint64(n)).astype(np.int64), n)
        return pa.Table.from_batches([by_bucket("home", begins, keys=keys[order], ids=ids[order], sizes=sizes[order], found=found[order])])

    def gathered(group: pa.Table) -> pa.Table:
        keys, ids = joined(group.column("keys"), "<u8"), joined(group.column("ids"), "<i8")
        sizes, found = joined(group.column("sizes"), "<u4").astype(np.int64), joined(group.column("found"), "<u4")
        order = np.lexsort((keys, found, ids))
        keys, ids, sizes = keys[order], ids[order], sizes[order]
        starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(ids)) if len(ids) else starts
        enough = (ends - starts) >= threshold(sizes[starts], percent)
        starts, ends = starts[enough], ends[enough]
        raw = [keys[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        return pa.table({"set_id": pa.array(ids[starts], pa.int64()), "n": pa.array(sizes[starts]), "keys": pa.array(raw, pa.binary())})

    sent = sets.select("set_id", "n", "keys").mapInArrow(frugal(send), "bucket int, sizes binary, keys binary, ids binary")
    back = sent.groupBy("bucket").applyInArrow(frugal_group(rarity), "home int, keys binary, ids binary, sizes binary, found binary")
    return back.groupBy("home").applyInArrow(frugal_group(gathered), "set_id long, n long, keys binary")


def _ties(sets: DataFrame, percent: int) -> DataFrame:
    """a, b: documents that have one of their rarest n - T + 1 shingles in common, each tied to the least of them.

    Shingles that no other document has count among the rarest, and are no longer in `keys`.
    """
    n = partitions(sets.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            sizes = batch.column("n").to_numpy()
            keys = [np.frombuffer(x.as_buffer(), "<u8") for x in batch.column("keys")]
            held = np.array([len(k) for k in keys], np.int64)
            prefix = held - threshold(sizes, percent) + 1  # the alone ones come first
            hashes = np.concatenate([np.zeros(0, np.uint64), *(k[:m] for k, m in zip(keys, prefix.tolist(), strict=True))])
            ids = np.repeat(batch.column("set_id").to_numpy(), prefix).astype("<i8")
            order, begins = dealt((mix(hashes) % np.uint64(n)).astype(np.int64), n)
            yield by_bucket("bucket", begins, keys=hashes[order], ids=ids[order])

    def tie(group: pa.Table) -> pa.Table:
        keys, ids = joined(group.column("keys"), "<u8"), joined(group.column("ids"), "<i8")
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        hub = ids[np.flatnonzero(first)][np.cumsum(first) - 1] if len(ids) else ids
        pairs = np.unique(np.stack([ids, hub], axis=1)[ids != hub], axis=0)
        return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})

    sent = sets.mapInArrow(frugal(send), "bucket int, keys binary, ids binary")
    return sent.groupBy("bucket").applyInArrow(frugal_group(tie), "a long, b long")


def links(ids: np.ndarray, sizes: np.ndarray, keys: list[np.ndarray], indexed: np.ndarray, asked: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """A spanning forest of the links between indexed and asked documents, which may be the same ones.

    `keys` need not hold shingles that no other document has. A link within what is tied already isn't verified.
    """
    order = np.argsort(sizes, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    held = np.array([len(k) for k in keys], np.int64)
    flat = np.concatenate([np.zeros(0, np.uint64), *keys])
    owner = np.repeat(place, held)
    _, shingle = np.unique(flat, return_inverse=True)
    # Inverted lists of the indexed documents, numbered by size; each list ascends.
    posted = np.repeat(indexed, held)
    by_list = np.lexsort((owner[posted], shingle[posted]))
    postings = owner[posted][by_list]
    counts = np.bincount(shingle[posted], minlength=int(shingle.max()) + 1 if len(shingle) else 0)
    list_starts = np.cumsum(counts) - counts
    own_starts = np.cumsum(held) - held
    tree = np.arange(len(ids))

    def root(x: int) -> int:
        while tree[x] != x:
            tree[x] = tree[tree[x]]
            x = tree[x]
        return x

    found = []
    both = bool((indexed & asked).any())
    for x in np.flatnonzero(asked[order]).tolist():
        doc = order[x]
        mine = shingle[own_starts[doc] : own_starts[doc] + held[doc]]
        starts, lengths = list_starts[mine], counts[mine]
        some = lengths > 0
        starts, lengths = starts[some], lengths[some]
        need = int(threshold(sizes[doc : doc + 1], percent)[0])
        if len(starts) < need:
            continue
        by_length = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[by_length], lengths[by_length]
        # DivideSkip: so many of the longest lists are only probed.
        long = min(need - 1, int(need / (PROBE_COST * np.log2(lengths[0] + 1) + 1)))
        merged = np.sort(postings[gather(starts[long:], lengths[long:])])
        edge = np.flatnonzero(np.concatenate([[True], merged[1:] != merged[:-1]])) if len(merged) else np.zeros(0, np.int64)
        others, times = merged[edge], np.diff(np.append(edge, len(merged)))
        often = (times >= need - long) & (others != x)
        if both:
            often &= others < x  # each pair once
        others, times = others[often], times[often].copy()
        if not len(others):
            continue
        mine_root = root(x)
        apart = np.array([root(y) != mine_root for y in others.tolist()])
        others, times = others[apart], times[apart]
        for start, length in zip(starts[:long].tolist(), lengths[:long].tolist(), strict=True):
            if not len(others):
                break
            probed = postings[start : start + length]
            at = np.minimum(np.searchsorted(probed, others), length - 1)
            times += probed[at] == others
        union = sizes[doc] + sizes[order[others]] - times
        for y in others[100 * times >= percent * union].tolist():
            a, b = root(x), root(y)
            if a != b:
                tree[max(a, b)] = min(a, b)
                found.append((int(ids[doc]), int(ids[order[y]])))
    return found


def _searched(sets: DataFrame, homes: DataFrame, percent: int) -> DataFrame:
    """a, b: links that tie the documents of each neighbourhood together."""
    n = partitions(sets.sparkSession)
    blocks = homes.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS).cast("int").alias("blocks"))
    placed = sets.join(homes, sets["set_id"] == homes["node"]).join(blocks, "component").drop("node")
    # Small neighbourhoods share a task; the blocks of a large one meet in pairs.
    placed = placed.withColumn("block", F.pmod(F.xxhash64("set_id"), "blocks").cast("int"))
    task = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(4 * n))).otherwise(F.col("component"))
    placed = placed.withColumn("task", task).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select(
        "set_id",
        "n",
        "keys",
        "block",
        (F.col("blocks") == 1).alias("small"),
        "task",
        F.least("block", "other").alias("left"),
        F.greatest("block", "other").alias("right"),
    )

    def search(key: tuple, group: pa.Table) -> pa.Table:
        ids, sizes, block = (group.column(c).to_numpy() for c in ("set_id", "n", "block"))
        left, right = key[2].as_py(), key[3].as_py()
        found = links(ids, sizes, rows_of(group.column("keys"), "<u8"), block == left, block == right, percent)
        return pa.table({"a": pa.array([x[0] for x in found], pa.int64()), "b": pa.array([x[1] for x in found], pa.int64())})

    return placed.groupBy("small", "task", "left", "right").applyInArrow(search, "a long, b long")


def near_copies(docs: DataFrame, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Of every row: doc_id, n_shingles (size of its shingle set), component_id (the least doc_id it reaches by links).

    Words are in lower case (A-Z); a text with fewer words than a shingle is one shingle, and texts without words have
    none, link with nothing and are their own component. Rows without an id take no part and have no component. Each
    row links by its own text; rows that share an id count as one document with the links of all. Empty tables give none.
    """
    meta = stored(set_table(docs, id_column, text_column))
    known = meta.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stored(known.groupBy("n_shingles", "a", "b").agg(F.min("doc_id").alias("rep")))
    shared = _shared_counts(docs, id_column, text_column)
    enough = F.col("shared") * 100 >= F.col("n_shingles") * percent
    chosen = stored(classes.join(shared, F.col("a") == F.col("set_id")).filter(enough).select("rep", "a"))
    sets = stored(_rare_first(stored(_candidates(docs, chosen, id_column, text_column)), percent))
    homes = components(_ties(sets, percent))
    # Rows with the same id but other texts tie their classes together.
    twice = known.groupBy("doc_id").agg(F.min("a").alias("least"), F.max("a").alias("most")).filter("least <> most")
    twice = known.join(twice, "doc_id").select("a", F.col("least").alias("b")).filter("a <> b").distinct()
    tied = components(_searched(sets, homes, percent).unionByName(twice))
    tied = stored(classes.select("a", "rep").join(tied, F.col("a") == F.col("node")).select("a", "rep", "component"))
    least = tied.groupBy("component").agg(F.min("rep").alias("component_id"))
    least = tied.join(least, "component").select("a", "component_id")
    groups = classes.join(least, "a", "left")
    groups = groups.select("n_shingles", "a", "b", F.coalesce("component_id", "rep").alias("component_id"))
    result = meta.join(groups, ["n_shingles", "a", "b"], "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return result.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text", unnamed: bool = False) -> DataFrame:
    """The document with the least id of each group of near copies, with all its columns.

    Each row is searched by its own text: rows with the same id and text count as one, other texts of that id as documents of their
    own. Documents without words are groups of their own. Rows without an id all stay; if `unnamed`, they are compared like the
    others, and only those without words all stay.
    """
    doc_id, text = F.col(id_column).cast("long"), F.col(text_column).cast("string")
    apart = doc_id.isNull() & ~F.coalesce(text.rlike(r"[^\x20\x09-\x0D]") & F.lit(unnamed), F.lit(False))
    key = F.xxhash64(doc_id, doc_id.isNull(), text, text.isNull())
    keyed = docs.filter(~apart).withColumn("row key", key)
    groups = near_copies(keyed, percent, "row key", text_column).select(F.col("doc_id").alias("row key"), "component_id").distinct()
    rows = keyed.select("row key", doc_id.alias("own id")).distinct().join(groups, "row key")
    first = F.min(F.struct(F.col("own id").isNull(), "own id", "row key"))
    stay = rows.groupBy("component_id").agg(first.alias("first")).select("first.row key")
    kept = keyed.join(stay, "row key", "left_semi").dropDuplicates(["row key"]).drop("row key")
    return kept.unionByName(docs.filter(apart))
