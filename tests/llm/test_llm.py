"""Each operator against brute force on small tables, with nulls, empty and odd texts, ties and repeated rows."""

import hashlib
import math
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from metricwatch.llm import chat, counts, decontamination, near, neighbours, oracle, packing, pitman_yor, private, quality, token_files
from metricwatch.llm.components import _large_star, _small_star, components
from metricwatch.llm.queries import QUERIES
from metricwatch.llm.tokens import BYTE_BPE, WORD_BPE, encoder, vocabulary

DOCS = "doc_id long, text string, lang string, source string, n_chars long, bucket int, score double, keys string"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    some = ["the", "cat", "sat", "on", "a", "mat", "Über", "naïve", "x.", "<|endoftext|>", "don't", "3.14", "日本"]
    made = [" ".join(rng.choice(some) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    words = [f"w{i}" for i in range(300)]
    base = rng.sample(words, 60)
    changed = [*base[:30], "other", *base[31:]]
    odd = [None, "", " \n\t ", "one", "a  b", "a \n \nb", " x  y", " <|endoftext|> ", "long" * 5000, "p q " * 4000]
    return [*made, *odd, " ".join(base), " ".join(base), " ".join(changed), " ".join(base[:40]), *made[:3]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "s", len(t or ""), 1, 0.5, "k") for i, t in enumerate(texts)]
    rows += [(None, "no id at all", "en", "s", 12, 1, 0.5, "k"), rows[3]]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def library(name):
    return Tokenizer.from_file(vocabulary(name))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", [WORD_BPE, BYTE_BPE])
def test_ids_are_the_library_s(texts, name):
    rng = random.Random(9)
    more = ["".join(rng.choice("  \n\ta'sÉ.1 !　<|") for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    given = [t or "" for t in texts] + more
    ids, n = encoder(vocabulary(name))(pa.array(given))
    wanted = [x.ids for x in library(name).encode_batch(given, add_special_tokens=False)]
    assert n.tolist() == list(map(len, wanted))
    assert ids.tolist() == [i for x in wanted for i in x]


@pytest.mark.parametrize("percentile", [50, 90, 99, 100])
def test_blocks_give_back_any_stretch(percentile):
    rng = np.random.default_rng(2)
    for n in (0, 1, 255, 256, 257, 5000):
        ids = np.where(rng.random(n) < 0.05, rng.integers(0, 2**32, n), rng.integers(100, 160, n)).astype(np.uint32)
        starts, payload = token_files.pack(ids, percentile)
        assert np.array_equal(token_files.unpack(payload, starts, n), ids)
        for a, b in ((0, 1), (250, 260), (n - 3, n), (300, 200)):
            assert np.array_equal(token_files.unpack(payload, starts, n, max(a, 0), b), ids[max(a, 0) : b])


def test_token_files(spark, docs):
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    path = token_files.write_token_files(docs, vocabulary(WORD_BPE))
    got = token_files.read_documents(spark, path).orderBy("start").collect()
    start, flat = 0, []
    for row, (doc_id, text) in zip(got, rows, strict=True):
        ids = [*library(WORD_BPE).encode(text, add_special_tokens=False).ids, 2]
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32, row.ids) == (doc_id, start, len(ids), crc(ids), ids)
        start, flat = start + len(ids), flat + ids
    parts = token_files.read_range(spark, path, 100, 900).orderBy("start").collect()
    assert [i for r in parts for i in r.ids] == flat[100:900]
    empty = token_files.write_token_files(docs.limit(0), vocabulary(WORD_BPE))
    assert token_files.read_digests(spark, empty).count() == 0


def test_counts_follow_edits(spark, docs, texts):
    rng = random.Random(6)
    edits = {}
    for i, text in enumerate(texts):
        some = [(rng.randint(0, len(text or "") + 9), rng.randint(0, 30), rng.choice(["", "a", " new", "\n \n", "<|endoftext|>"])) for _ in range(4)]
        edits[i] = [*some, None, (None, 1, "x")]
    kind = "doc_id long, edits array<struct<at:int,removed:int,inserted:string>>"
    given = docs.drop("edits").join(spark.createDataFrame(list(edits.items()), kind), "doc_id", "left")
    count = lambda t: len(library(BYTE_BPE).encode(t, add_special_tokens=False).ids)
    got = counts.edited_counts(given, vocabulary(BYTE_BPE)).collect()
    assert len(got) == docs.count()
    after = {}
    for row in got:
        text = "no id at all" if row.doc_id is None else texts[row.doc_id] or ""
        assert row.n_tokens == count(text)
        for edit in edits.get(row.doc_id, []):
            if edit and edit[0] is not None:
                at = min(edit[0], len(text))
                text = text[:at] + edit[2] + text[at + edit[1] :]
        assert row.n_tokens_after == count(text)
        after[row.doc_id] = text
    stored = counts.token_trees(docs, vocabulary(BYTE_BPE)).join(given.select("doc_id", "edits").distinct(), "doc_id")
    for row in counts.apply_edits(stored, vocabulary(BYTE_BPE)).collect():
        assert row.text == after[row.doc_id] and sum(row.tokens) == count(row.text)


def test_model_s_counts_and_probabilities(spark, docs):
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    split = lambda t: [*t.encode().lower().split(), None]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in rows if not held(i) for w in split(t))
    n, v = sum(c.values()), len(c)
    got = pitman_yor.Model(docs).scores().collect()
    key = lambda r: (r[0] is not None, r[0] or 0)
    for row, (doc_id, text) in zip(sorted(got, key=key), sorted(rows, key=key), strict=True):
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in split(text))
        assert (row.doc_id, row.held_out, row.n_tokens, row.train_tokens) == (doc_id, held(doc_id), len(split(text)), n)
        assert row.n_known == sum(c[w] > 0 for w in split(text))
        assert row.base_score == pytest.approx(base) and row.score < 0


def test_model_s_probabilities_add_up(spark):
    vocabulary_ = [f"w{i}" for i in range(6)]
    rng = random.Random(1)
    learnt = [" ".join(rng.choice(vocabulary_[: 2 + i % 5]) for _ in range(20)) for i in range(60)]
    rows = [(i, t) for i, t in enumerate(learnt)]
    # After "w0", every word that can follow, as held-out documents; scores without what comes before and the end.
    free = [i for i in range(1000, 3000) if zlib.crc32(str(i).encode()) % 7 == 2]
    probes = [*vocabulary_, "unheard"]
    rows += [(free[2 * k], f"w0 {w}") for k, w in enumerate(probes)] + [(free[2 * k + 1], w) for k, w in enumerate(probes)]
    empty = free[100]
    rows += [(empty, ""), (free[101], "w0")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in pitman_yor.Model(frame).scores().collect()}
    first = {w: got[free[2 * k + 1]] for k, w in enumerate(probes)}  # p(w | begin) p(end | w)
    second = {w: got[free[2 * k]] for k, w in enumerate(probes)}  # p(w0 | begin) p(w | w0) p(end | w)
    # p(w0 | begin) p(w | w0) p(end | w) / (p(w | begin) p(end | w)) = p(w0 | begin) p(w | w0) / p(w | begin), so with the
    # words' shares at the beginning unknown, compare with the sum over words that begin a text.
    assert all(10 ** x < 1 for x in [*first.values(), *second.values()])
    assert first["w0"] > first["unheard"] and second["w1"] > second["unheard"]


def test_seating_is_within_bounds():
    rng = np.random.default_rng(3)
    customers = np.array([0, 1, 2, 50, 10**9])
    tables = pitman_yor.seated(customers, np.zeros(5, np.int64), np.full(5, 0.1), 0.5, rng)
    assert tables[:2].tolist() == [0, 1] and (tables <= customers).all() and (tables[1:] >= 1).all()


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        twice = lambda i, x: x if i % 2 == 0 else 2 * x - 9 * (x > 4)
        return 13 <= len(digits) <= 19 and sum(twice(i, int(x)) for i, x in enumerate(reversed(digits))) % 10 == 0
    return 9 <= len(digits) <= 15 if kind == "phone" else True


def test_entities_are_found_as_by_plain_patterns(spark):
    rng = random.Random(8)
    parts = ["a.b@c.d", "x@y", "@", "..", "10.0.0.1", "1.2.3.400", "0000.1.2.3", "4111 1111 1111 1111", "4111-1111", "+1 (906) 555-7738", "+12", "é", " ", "日", "-", "9" * 40, "a" * 50]
    given = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    given += [None, "", "4111111111111111 4111111111111111", "a@b.c%d@e.f", "7" * 20000, "a" * 20000]
    frame = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    rows = {r.doc_id: r for r in private.entity_spans(frame).collect()}
    assert len(rows) == len(given)
    for i, text in enumerate(given):
        for kind, pattern in PATTERNS.items():
            wanted = [(m.start(), m.end()) for m in re.finditer(pattern, text or "") if holds(kind, m[0])]
            assert [(s.start, s.end) for s in rows[i][kind]] == wanted, (text, kind)


def test_terms_that_disclose_an_entity(spark):
    filler = [f"word{i} and more of the usual text" for i in range(60)]
    said = [f"{a} wrote Zorblax zo@example.org about {b}" for a, b in (("He", "cats"), ("She", "dogs"), ("They", "fish"), ("One", "birds"))]
    given = [*filler, *said, *said, "wrote about Anna to anna@example.org"]
    frame = spark.createDataFrame([(i, t, 1) for i, t in enumerate(given)], "doc_id long, text string, key int")
    found = {r.doc_id: {given[r.doc_id][s.start : s.end] for s in r.term} for r in private.entity_spans(frame).collect()}
    assert all("Zorblax" in found[i] for i in range(60, 68))
    assert not any(found[i] for i in range(60)) and not found[68]
    clean = {r.doc_id: r for r in private.sanitised(frame).collect()}
    assert "Zorblax" not in clean[60].text and "[EMAIL]" in clean[60].text and clean[60].text.startswith("He ")
    assert clean[0].text == given[0] and clean[0].key == 1
    nothing = private.sanitised(frame.limit(0))
    assert nothing.count() == 0 and nothing.columns == frame.columns


def test_terms_far_from_an_entity_in_fixed_or_few_surroundings(spark):
    rng = random.Random(12)
    filler = [" ".join(f"w{rng.randrange(300)}" for _ in range(20)) for _ in range(2000)]
    signed = [f"{filler[i]} yours Jane Quibble of the seventh floor to the right jane@x.org staff no 90210417 end {filler[-i - 1]}" for i in range(10)]
    pair = [f"{filler[40 + i]} {'Zorblax' if i < 2 else ''} {filler[70 + i]} {filler[90 + i]} zo@example.org" for i in range(2)]
    single = [f"{filler[110]} Anna anna@example.org"]
    given = [*filler, *signed, *pair, *single]
    frame = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    found = {r.doc_id: {given[r.doc_id][s.start : s.end] for s in r.term} for r in private.entity_spans(frame).collect()}
    want = {"yours", "Jane", "Quibble", "seventh", "floor", "right", "staff", "90210417"}
    assert all(want <= found[i] for i in range(2000, 2010))
    assert found[2010] == found[2011] == {"Zorblax"}
    assert not found[2012] and not any(found[i] for i in range(2000))
    assert "90210417" not in private.sanitised(frame).filter("doc_id = 2003").head().text


def test_disclosing_terms_are_those_of_plain_counting(spark):
    rng = random.Random(21)
    known = [f"p{i}@m.org" for i in range(12)]
    given = []
    for i in range(1500):
        parts = [f"t{rng.randrange(400)}" for _ in range(12)]
        if rng.random() < 0.1:
            n = rng.randrange(12)
            parts += [known[n], f"name{n}" if rng.random() < 0.97 else "other", f"{7000 + n}", f"P{n}"]
            rng.shuffle(parts)
        given.append(" ".join(parts))
    holds = [{m for m in known if re.search(rf"(?<!\S){m}(?!\S)", t)} for t in given]
    words = [set(re.findall(r"[^\W_]{2,}", re.sub(r"\S+@\S+", " ", t.lower()))) for t in given]
    n, n_term, n_entity = len(set(given)), Counter(w for ws in words for w in ws), Counter(e for es in holds for e in es)
    both = Counter((e, w) for es, ws in zip(holds, words) for e in es for w in ws)
    bad = set()
    for (e, w), k in both.items():
        chance = len(n_term) * math.comb(n_entity[e], k) * math.comb(n_term[w], k) / math.comb(n, k)
        if chance <= private.CHANCE and math.log(k * n / n_entity[e] / n_term[w]) >= private.GENERALISE * math.log(n / n_entity[e]):
            bad.add((e, w))
    frame = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    assert n == len(given) and len({w for _, w in bad}) > 20
    for r in private.entity_spans(frame).collect():
        got = {given[r.doc_id][s.start : s.end].lower() for s in r.term if not any(e.start <= s.start < e.end for e in r.email)}
        assert got == {w for e, w in bad if e in holds[r.doc_id] and w in words[r.doc_id]}, given[r.doc_id]


def test_overlapping_spans_are_replaced_whole(spark):
    given = ["a +1 (545) 555-9193.jo@x.com b", "+1 906 555 10.0.0.1 c", "x 4111111111111111@y.org z", "jo@x.com"]
    frame = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in private.sanitised(frame).collect()}
    assert got == {0: "a [PHONE][EMAIL] b", 1: "[PHONE] c", 2: "x [EMAIL] z", 3: "[EMAIL]"}


def test_conversations_come_back(spark):
    rng = random.Random(5)
    marks = [*chat.CONTROL, chat.ESCAPE, "text", " ", "\n", "é", "日本"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "[INST]"]), "".join(rng.choice(marks) for _ in range(rng.randint(0, 9)))) for c in range(12) for t in range(rng.randint(1, 6))]
    rows += [(100, 0, "user", None), (None, None, "assistant", "x"), (101, 0, "assistant", "same"), (101, 0, "assistant", "same")]
    frame = chat.planted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    path = vocabulary(BYTE_BPE)
    assembled = chat.assemble(frame, path)
    got = {r.conv_id: r for r in chat.digests(assembled, path).collect()}
    rendered = {r.conv_id: r.n for r in assembled.groupBy("conv_id").agg(F.sum(F.length("text")).alias("n")).collect()}
    by = {}
    for conv, t, role, text in rows:
        by.setdefault(conv, []).append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(by)
    for conv, said in by.items():
        said.sort()
        turns = "".join(f"{role}\n{text}\n" for _, role, text in said)
        learnt = "".join(text for _, role, text in said if role == "assistant")
        row = got[conv]
        assert (row.n_turns, row.turns_sha256) == (len(said), hashlib.sha256(turns.encode()).hexdigest())
        assert (row.loss_chars, row.loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
        assert row.formatted_chars == rendered[conv]
    assert all(chat.unescape(chat.escape(x)) == x for _, _, _, x in rows if x)


def test_nearest_vectors(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 16)) * rng.uniform(0.5, 2, (900, 1))
    x[100:400] = x[100]
    rows = [(i, [float(v) for v in x[i]], "k") for i in range(900)]
    rows += [(1000, None, "k"), (1020, [0.0] * 16, "k"), (1040, [float("nan")] * 16, "k"), (1060, [None] * 16, "k"), (1080, [1.0], "k"), (None, rows[0][1], "k")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string").repartition(4)
    got = {}
    for r in neighbours.nearest_vectors(frame).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, 900, 20))
    hits = 0
    for q, found in got.items():
        scores = np.einsum("nd,d->n", x, x[q])
        best = [i for i in np.lexsort((np.arange(900), -scores)).tolist() if i != q][:20]
        assert found == sorted(found, key=lambda f: (-f[1], f[0])) and all(s == pytest.approx(scores[i]) for i, s in found)
        hits += len({i for i, _ in found} & set(best))
    assert hits >= 0.9 * 20 * len(got)
    few = neighbours.nearest_vectors(frame.filter("vec_id < 3")).collect()
    assert [(r.query_id, r.rank) for r in sorted(few, key=lambda r: r.rank)] == [(0, 1), (0, 2)]
    assert neighbours.nearest_vectors(frame.limit(0)).count() == 0


def test_a_search_among_many_centroids_takes_little_memory():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(2400, 65))
    centroids = neighbours.Centroids(points, neighbours._graph(points, rng), 20.0, prune=1.3)
    x = rng.normal(size=(400, 64))
    tracemalloc.start()
    try:
        centroids.filed(centroids.lifted(x))
        read = centroids.read(np.hstack([x, np.zeros((400, 1))]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 100 << 20
    gaps = centroids.gaps(np.hstack([x, np.zeros((400, 1))]))
    assert (read == (gaps <= 1.3 * gaps.min(1, keepdims=True))).mean() > 0.99


def test_vectors_and_queries_go_to_pieces_of_bounded_size(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 8)).astype(np.float32)
    x[200:900] = x[200]  # a list longer than a slot
    rows = [(i, [float(v) for v in x[i]]) for i in range(1500)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    whole = sorted(map(tuple, neighbours.nearest_vectors(frame, every=5).collect()))
    monkeypatch.setattr(neighbours, "SLOT_BYTES", 100 * 32)
    monkeypatch.setattr(neighbours, "ASK_BYTES", 50 * 32)
    assert sorted(map(tuple, neighbours.nearest_vectors(frame, every=5).collect())) == whole
    assert len(whole) == 300 * 20
    first, parts = neighbours._slots(np.array([3, 0, 25, 4, 4, 4]), 10)
    assert (first.tolist(), parts.tolist()) == ([0, 0, 1, 4, 4, 5], [1, 1, 3, 1, 1, 1])
    assert [neighbours._lists(first, parts, slot) for slot in range(6)] == [slice(0, 2), slice(2, 3), slice(2, 3), slice(2, 3), slice(3, 5), slice(5, 6)]


def frames(docs, **tables):
    """DuckDB over the given rows."""
    made = duckdb.connect()
    made.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    made.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    made.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    made.executemany("INSERT INTO benchmark VALUES (?, ?)", tables.get("items", [(None, None)]))
    return made


def test_benchmark_items_in_documents(spark, docs, texts):
    cut = (texts[-6] or "").split()
    items = [(1, " ".join(cut[:20])), (1, " ".join(cut[:20])), (2, " ".join([*cut[:30], "x", "y"])), (3, "one"), (4, None), (5, ""), (None, texts[0]), (6, texts[1])]
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contained(docs, frame)
    plain = [(r.doc_id, r.text) for r in docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).collect()]
    known = frames(plain, items=list(dict.fromkeys((i, t) for i, t in items if i is not None and t)))
    wanted = known.execute(oracle.ORACLE["op7_benchmark_containment"]).fetchall()
    assert sorted((r.doc_id, r.item_id, r.n_shingles, r.overlap, r.containment) for r in got.collect()) == sorted(wanted) != []
    kept = decontamination.decontaminated(docs, frame)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - {w[0] for w in wanted}
    assert decontamination.contained(docs, frame.limit(0)).count() == 0


def test_short_benchmark_items_inside_documents(spark):
    items = [(n, " ".join(f"Item{n}{x}" for x in range(n))) for n in range(1, 7)]
    given = [f"some words before {t.upper()} and some more" for _, t in items] + [t for _, t in items]
    given += ["item30 item31 x item32", "some words that are no item at all", "item40 item41 item42", "", None]
    docs = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    frame = spark.createDataFrame(items, "item_id long, text string")
    held = {(i, n) for i, t in enumerate(given) for n, item in items if f" {item.lower()} " in f" {(t or '').lower()} "}
    got = decontamination.contained(docs, frame, inside=True).collect()
    assert {(r.doc_id, r.item_id) for r in got} == held and len(got) == len(held) == 12
    assert {r.doc_id for r in decontamination.decontaminated(docs, frame).collect()} == set(range(12, 17))


def test_near_copies(spark):
    rng = random.Random(12)
    words = [f"v{i}" for i in range(4000)]
    families = []
    for _ in range(12):
        base = rng.sample(words, rng.randint(6, 90))
        families.append(base)
        for _ in range(rng.randint(0, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            families.append(copy)
            base = copy if rng.random() < 0.4 else base
    given = [" ".join(f) for f in families] + ["", None, " \n ", "one two", "ONE two", "one two three four five", "x " * 3000]
    line = " ".join(words[:8])
    given += [f"{line} {' '.join(rng.sample(words, 30))}" for _ in range(30)]
    rows = list(enumerate(given))
    rng.shuffle(rows)
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n int").repartition(5)
    wanted = sorted(frames(rows).execute(f"WITH RECURSIVE {oracle.near_copies('documents')} SELECT * FROM near_groups").fetchall())
    got = near.near_copies(frame)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == wanted
    assert sum(w[0] != w[2] for w in wanted) > 20
    block, near.BLOCK_DOCS = near.BLOCK_DOCS, 4  # as for neighbourhoods too large for one task
    try:
        assert sorted(tuple(r) for r in near.near_copies(frame).collect()) == wanted
    finally:
        near.BLOCK_DOCS = block
    repeated = frame.unionByName(frame).unionByName(spark.createDataFrame([(None, given[0], 1)], frame.schema))
    left = near.one_of_each(repeated)
    assert left.columns == frame.columns
    assert sorted(r.doc_id for r in left.filter("doc_id IS NOT NULL").collect()) == sorted({w[2] for w in wanted})
    assert left.filter("doc_id IS NULL").count() == 1
    assert near.near_copies(frame.limit(0)).count() == 0


def test_keys_of_a_bucket_are_looked_up_in_little_memory(monkeypatch):
    rng = np.random.default_rng(5)
    keys, lengths = rng.integers(0, 40, 60).astype("<u4"), np.array([1, 20, 2, 30, 7])
    times = Counter(keys.tolist())
    wanted = [sum(times[k] > 1 for k in part.tolist()) for part in np.split(keys, np.cumsum(lengths)[:-1])]
    monkeypatch.setattr(near, "KEYS_AT_ONCE", 7)
    assert near._repeated(keys, lengths).tolist() == wanted and 0 < sum(wanted) < 60
    assert near._repeated(np.arange(9, dtype="<u4"), np.array([4, 5])).tolist() == [0, 0]
    monkeypatch.undo()
    keys = rng.integers(0, 1 << 20, 1_000_000).astype("<u4")
    tracemalloc.start()
    try:
        near._repeated(keys, np.full(1000, 1000))
        assert tracemalloc.get_traced_memory()[1] < 4 * keys.nbytes  # 31 MB before
    finally:
        tracemalloc.stop()


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    reach = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}
    for _ in range(len(edges)):
        for a, b in edges:
            if a in reach and b in reach and a != b:
                reach[a] = reach[b] = min(reach[a], reach[b])
    assert got == reach


def test_components_of_named_nodes(spark):
    """Nodes that are text, some like numbers, of components that take several rounds."""
    edges = [(f"{(i * 37) % 64:02X}F", f"{((i + 1) * 37) % 64:02X}F") for i in range(40)] + [("9", "10"), ("10", "10"), (None, "9"), ("9A", "")]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "key string, `to` string"), "key", "to").collect()}
    path = [f"{(i * 37) % 64:02X}F" for i in range(41)]
    assert got == {x: min(path) for x in path} | {"9": "10", "10": "10", "9A": "", "": ""}


def test_components_take_one_shuffle_a_step(spark):
    now = spark.createDataFrame([(2, 1), (3, 2), (3, 1), (3, 1)], "u long, v long")
    step = _small_star(_large_star(now))
    assert step._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 2
    assert {tuple(r) for r in step.collect()} == {(2, 1), (3, 1)}


def test_packing(spark, docs):
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    got = packing.best_fit(packing.token_pieces(docs, vocabulary(BYTE_BPE), keep_ids=True)).collect()
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.length == len(r.ids) and r.ids_crc32 == crc(r.ids)
    for parts in by.values():
        parts.sort()
        assert [p[0] for p in parts] == [sum(p[1] for p in parts[:i]) for i in range(len(parts))] and sum(p[1] for p in parts) <= 2048
    pieces = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got)
    wanted = Counter()
    for doc_id, text in rows:
        ids = [*library(BYTE_BPE).encode(text, add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids), 2048), len(ids)] if len(ids) > 2048 else [0, len(ids)]
        wanted.update((doc_id, k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert pieces == wanted
    assert packing.best_fit(packing.token_pieces(docs.limit(0), vocabulary(BYTE_BPE))).count() == 0


def test_open_bins_close_the_fullest_first():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(x) for x in (6, 5, 8)] == [(0, 0), (1, 0), (2, 0)]  # the third closes itself, the fullest
    assert [bins.place(x) for x in (2, 4)] == [(0, 6), (1, 5)]


def test_quality(spark):
    rng = random.Random(7)
    good = lambda: " ".join(rng.choice(["plain", "words", "of", "prose", "and", "more"]) for _ in range(rng.randint(5, 80))) + "."
    bad = lambda: " ".join(rng.choice(["BUY", "NOW"]) + "!!" for _ in range(rng.randint(5, 80)))
    rows = [(i, good() if i % 3 else bad(), float(i), "k") for i in range(300)] + [(900, None, 0.0, "k"), (901, "", 0.0, "k"), (None, "plain words.", 0.0, "k")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score double, raw string")
    labels = spark.createDataFrame([(i, int(bool(i % 3))) for i in range(300)] + [(0, None), (None, 1), (1, 7)], "doc_id long, quality int")
    model = quality.fit(frame, labels)
    got = quality.with_score(frame.drop("score"), model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 300 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert held and all((r.score >= quality.ACCEPT) == bool(r.doc_id % 3) for r in held)
    kept = quality.accepted(frame, labels)
    assert kept.columns == frame.columns and kept.filter("raw = 'k'").count() == kept.count()
    assert quality.with_score(frame.limit(0), quality.fit(frame, labels.limit(0))).count() == 0


def test_near_copies_of_rows_that_share_or_lack_an_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a), (1, b), (1, b), (2, a), (3, b + " more"), (None, c), (None, c), (None, c + " more"), (4, b), (None, a), (None, ""), (None, None), (5, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.text) for r in near.one_of_each(frame, unnamed=True).collect())
    assert got.pop((None, c), 0) + got.pop((None, c + " more"), 0) == 1
    assert got == Counter([(1, a), (1, b), (None, ""), (None, None), (5, "")])


def test_pairs_are_fitted_in_blocks():
    rng = np.random.default_rng(5)
    z = rng.normal(size=(3000, 50))
    order = np.argsort(z[:, :5].sum(1) + rng.normal(size=3000))
    better, worse = rng.choice(order[1500:], quality.PAIRS), rng.choice(order[:1500], quality.PAIRS)
    assert quality.PAIRS == 200_000
    tracemalloc.start()
    w = quality._logistic(z, better, worse)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6  # all gaps together take 80 MB
    gap = z[better] - z[worse]
    slope = -gap.T @ (1 / (1 + np.exp(gap @ w))) / len(gap) + 1e-3 * w
    assert np.abs(slope).max() < 1e-8


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_queries_give_what_their_sql_gives(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    made = duckdb.connect()
    for table in ("documents", "benchmark"):
        made.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    wanted = made.execute(oracle.ORACLE[name])
    columns = [c[0] for c in wanted.description]
    got = QUERIES[name](spark, sf_dir)
    assert sorted(columns) == sorted(got.columns)
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(wanted.fetchall())


def test_pipeline(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, count = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir))
        assert docs.columns == names and 0 < docs.count() <= count
        count = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}
    assert corpus_pipeline.run(spark, sf_dir).count() == packed.count()


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def plainly_sanitised(text):
    """Without terms: on the smallest table no entity is in two different texts."""
    spans = [(m.start(), -m.end(), kind) for kind, p in PATTERNS.items() for m in re.finditer(p, text) if holds(kind, m[0])]
    out, at = "", 0
    for start, back, kind in sorted(spans):
        if -back > at:
            out += text[at : max(at, start)] + f"[{kind.upper()}]"
            at = -back
    return out + text[at:]


def test_pipeline_stages_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    stages = [stage for _, stage in corpus_pipeline.STAGES]
    kept = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for stage in stages[:4]:
        kept.append(corpus_pipeline.stored(stage(spark, kept[-1], sf_dir)))
    rows = [{r.doc_id: r.text for r in k.collect()} for k in kept]
    assert all(len(r) == k.count() for r, k in zip(rows, kept))
    sets = {i: grams(t) for i, t in rows[1].items()}
    group = {i: i for i in sets}
    for x in sorted(sets):
        for y in sets:
            both, either = len(sets[x] & sets[y]), len(sets[x] | sets[y])
            if x < y and both and 100 * both >= near.PERCENT * either:
                old, new = max(group[x], group[y]), min(group[x], group[y])
                group = {i: new if g == old else g for i, g in group.items()}
    assert set(rows[2]) == {i for i, g in group.items() if i == g}
    items = [grams(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaking = {i for i in rows[2] if any(s and 100 * len(s & sets[i]) >= decontamination.PERCENT * len(s) for s in items)}
    assert set(rows[3]) == set(rows[2]) - leaking
    assert rows[4] == {i: plainly_sanitised(t) for i, t in rows[3].items()} != rows[3]


def test_a_text_of_very_many_entities_takes_no_longer_than_its_share(spark):
    given = [" ".join(f"user{i}@host{i % 97}.example.org" for i in range(n)) for n in (2000, 32000)]
    frame = spark.createDataFrame(list(enumerate([*given, "é" * 5000 + " a@b.cd " + "日" * 9000 + " x@y.zz "])), "doc_id long, text string")
    private.sanitised(frame.filter("doc_id = 0")).collect()
    began = time.monotonic()
    found = {r.doc_id: r for r in private._with_entities(frame, "text").select("doc_id", "email").collect()}
    assert len(found[1].email) == 32000 and (found[1].email[-1].end, found[1].email[0].start) == (len(given[1]), 0)
    assert time.monotonic() - began < 5
    began = time.monotonic()
    clean = {r.doc_id: r.text for r in private.sanitised(frame).collect()}
    assert clean[1] == " ".join(["[EMAIL]"] * 32000) and clean[2] == "é" * 5000 + " [EMAIL] " + "日" * 9000 + " [EMAIL] "
    assert time.monotonic() - began < 30


def test_running_folds(spark):
    rng = random.Random(2)
    rows = [(i, [rng.randint(0, 99) for _ in range(n)]) for i, n in enumerate((0, 1, 63, 64, 65, 128, 1000))] + [(9, None)]
    frame = spark.createDataFrame(rows, "i int, x array<int>")
    got = frame.select("i", private._before("x", lambda a, b: a + b).alias("sums"), private._before("x", private._larger).alias("tops"))
    for r in got.collect():
        values = dict(rows)[r.i]
        assert r.sums == (None if values is None else [sum(values[:k]) for k in range(len(values))])
        assert r.tops == (None if values is None else [max([0, *values[:k]]) for k in range(len(values))])


def test_entities_and_words_of_the_same_texts_are_no_product(spark):
    names, mails = [f"Word{i}" for i in range(1500)], [f"m{i}@x.org" for i in range(1500)]
    rng = random.Random(6)
    filler = [" ".join(f"w{rng.randrange(300)}" for _ in range(20)) for _ in range(600)]
    lists = [f"{filler[i]} {' '.join(names)} {' '.join(mails)}" for i in range(5)]
    frame = spark.createDataFrame(list(enumerate([*filler, *lists])), "doc_id long, text string")
    found = {r.doc_id: len(r.term) for r in private.entity_spans(frame).collect()}
    assert all(found[i] == 1500 for i in range(600, 605)) and not any(found[i] for i in range(600))


def test_empty_tables_give_empty_results(spark):
    path, docs = vocabulary(BYTE_BPE), spark.createDataFrame([], DOCS)
    assert pitman_yor.Model(docs).scores().count() == 0
    edits = F.lit(None).cast("array<struct<at:int,removed:int,inserted:string>>")
    assert counts.edited_counts(docs.select("doc_id", "text").withColumn("edits", edits), path).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert chat.digests(chat.assemble(turns, path), path).count() == 0


def test_conversations_with_columns_of_other_names(spark):
    path = vocabulary(BYTE_BPE)
    rows = [(c, t, role, f"text {t} </s>", 5, "x", 1, "y") for c in (1, 2) for t, role in enumerate(("user", "assistant"))]
    given = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, start int, ids string, position int, loss string")
    plain = given.select("conv_id", "turn", "role", "text")
    told = [sorted(map(str, chat.digests(chat.assemble(x, path), path).collect())) for x in (given, plain)]
    assert told[0] == told[1] and len(told[0]) == 2
