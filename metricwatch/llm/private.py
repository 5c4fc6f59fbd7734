"""Personal data: entities found by pattern, and the terms that would give them away.

An entity is an e-mail address, IP address, card number or phone number. From the whole corpus it is counted in how many
different texts an entity, a term, and both occur, wherever in the text; what lies within entities is no term. The pointwise
mutual information of the two, as a share of the entity's own information, is how much of the entity the term discloses: 1 if it
occurs nowhere else. In documents with the entity, terms that disclose GENERALISE of it or more are replaced by their
kind, from REMOVE on they are removed.

Rare words meet rare entities by chance, so a pair must be significant too. If a term's n_term texts were drawn from all
`texts` at random, it would share n_both texts with the entity with a probability of at most the expected number of groups of
n_both texts that hold both: C(n_entity, n_both) * C(n_term, n_both) / C(texts, n_both). This times the number of different terms, all of
which were tried, must not exceed CHANCE. What is met in one text only can't pass unless the corpus has far fewer terms than texts.

All work is done by Spark's own expressions. Matches are placed by the pieces of text between them, in code points.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricwatch.llm.shared import stored

KINDS = ("email", "ip", "card", "phone")
#: Disclosed share of an entity's information from which a term is generalised, or removed.
GENERALISE, REMOVE = 0.9, 0.98
#: Terms that an entity may be expected to meet as often by chance, at most.
CHANCE = 0.01
#: Places of a block of a running fold, and code points of a piece of text.
PLACES, PIECE = 64, 4096

# The patterns given for base entities, written so that Java neither backtracks over a run nor begins within one.
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for its kind to be sought at all.
_HINTS = {"email": "@", "phone": "+", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]"}
_TERM = r"[\p{L}\p{N}]{2,}"
_SPANS = "array<struct<start:int,end:int>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    digits = F.reverse(_digits(match))
    places = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, place, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(place % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _holds(kind: str, match: Column) -> Column:
    """Whether a match of the pattern is one of the kind."""
    length = F.length(_digits(match))
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.when(length.between(13, 19), _luhn(match)).otherwise(F.lit(False))
    if kind == "phone":
        return length.between(9, 15)
    return F.lit(True)


def _placed(df: DataFrame, name: str, pattern: str, text: str, sought: Column, keep: Callable[[Column], Column]) -> DataFrame:
    """Adds array column `name` of (start, end), code points, of those matches that `keep` holds for."""
    matches, gaps = f"{name} matches", f"{name} gaps"
    lengths, before = f"{name} lengths", f"{name} before"
    df = df.withColumn(matches, F.when(sought, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    some = F.coalesce(F.size(matches) > 0, F.lit(False))
    df = df.withColumn(gaps, F.when(some, F.split(F.col(text), pattern, -1)))
    df = df.withColumn(lengths, F.transform(F.when(some, F.col(matches)), lambda m, i: F.length(F.get(gaps, i)) + F.length(m)))
    df = df.withColumn(before, _before(lengths, lambda total, x: total + x))

    def span(match: Column, i: Column) -> Column:
        start, end = F.get(before, i) + F.length(F.get(gaps, i)), F.get(before, i) + F.get(lengths, i)
        return F.when(keep(match), F.struct(start.alias("start"), end.alias("end")))

    found = F.array_compact(F.transform(F.when(some, F.col(matches)), span))
    return df.withColumn(name, F.coalesce(found, F.array().cast(_SPANS))).drop(matches, gaps, lengths, before)


def _larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _before(values: str, fold: Callable[[Column, Column], Column]) -> Column:
    """Of each place of an int column's array, the values before it folded, from 0 on.

    An array that grows is copied with each step, so it is done in blocks, and then for the blocks: no array grows past PLACES
    in one and past the number of blocks in the other.
    """
    n, ints = F.size(values), F.array().cast("array<int>")
    numbers = F.sequence(F.lit(0), F.floor((n - 1) / PLACES).cast("int"))
    blocks = F.transform(numbers, lambda b: F.slice(values, b * PLACES + 1, PLACES))

    def run(items: Column, start: Column) -> Column:
        def step(state: Column, x: Column) -> Column:
            return F.struct(fold(state["at"], x).alias("at"), F.array_append(state["done"], state["at"]).alias("done"))

        return F.aggregate(items, F.struct(start.alias("at"), ints.alias("done")), step)["done"]

    starts = run(F.transform(blocks, lambda x: F.aggregate(x, F.lit(0), fold)), F.lit(0))
    return F.when(n > 0, F.flatten(F.zip_with(blocks, starts, run))).when(n == 0, ints)


def _pieces(text: str, wanted: Column) -> Column:
    """A text in pieces of PIECE code points, where wanted: finding a place from its beginning takes as long as it is far."""
    return F.when(wanted, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)))


def _cut(pieces: str, begin: Column, end: Column) -> Column:
    """The code points from begin to end of a text in pieces."""
    first, last = F.floor(begin / PIECE).cast("int"), F.floor((end - 1) / PIECE).cast("int")
    joined = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
    # The column is named twice, lest Spark put what makes it into a lambda, which would cut the text for each place anew.
    return F.when((end > begin) & (F.size(pieces) > 0), F.substring(joined, begin - first * PIECE + 1, end - begin)).otherwise("")


def _with_entities(df: DataFrame, text: str) -> DataFrame:
    """Adds an array of (start, end) per kind."""
    for kind in KINDS:
        hint = _HINTS[kind]
        sought = F.col(text).contains(hint) if len(hint) == 1 else F.col(text).rlike(hint)
        df = _placed(df, kind, _PATTERNS[kind], text, sought, partial(_holds, kind))
    return df


def _each(kind: str, make: Callable[[Column, str], Column]) -> Column:
    """make(span, kind) of each span in the column of that kind."""
    return F.transform(kind, lambda span: make(span, kind))


def _with_merged(df: DataFrame, name: str, spans: Column) -> DataFrame:
    """Adds the spans in order, those that overlap as one; null where `spans` is."""
    order, ends, reach, firsts = (f"{name} {part}" for part in ("order", "ends", "reach", "firsts"))
    df = df.withColumn(order, F.array_sort(spans)).withColumn(ends, F.transform(order, lambda s: s["end"]))
    df = df.withColumn(reach, _before(ends, _larger))
    some = F.when(F.size(order) > 0, F.sequence(F.lit(0), F.size(order) - 1)).when(F.size(order) == 0, F.array().cast("array<int>"))
    df = df.withColumn(firsts, F.filter(some, lambda i: F.get(order, i)["start"] >= F.get(reach, i)))

    def merged(i: Column, k: Column) -> Column:
        end = F.coalesce(F.get(reach, F.get(firsts, k + 1)), F.array_max(ends))
        return F.struct(F.get(order, i)["start"].alias("start"), end.alias("end"))

    return df.withColumn(name, F.transform(firsts, merged)).drop(order, ends, reach, firsts)


def _with_words(found: DataFrame, text: str) -> DataFrame:
    """Adds `words`, the distinct terms in lower case that a text has outside its entities."""
    found = _with_merged(found, "covered", F.when(_some(), F.concat(*KINDS)))
    found = found.withColumn("pieces", _pieces(text, F.col("covered").isNotNull()))

    def between(i: Column) -> Column:
        start = F.coalesce(F.get("covered", i - 1)["end"], F.lit(0))
        return _cut("pieces", start, F.coalesce(F.get("covered", i)["start"], F.length(text)))

    gaps = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.size("covered")), between))
    found = found.withColumn("outside", F.when(F.col("covered").isNotNull(), gaps).otherwise(F.col(text)))
    terms = F.transform(F.regexp_extract_all("outside", F.lit(_TERM), F.lit(0)), F.lower)
    return found.withColumn("words", F.array_distinct(terms)).drop("covered", "outside", "pieces")


def _some() -> Column:
    return F.greatest(*(F.size(k) for k in KINDS)) > 0


def _mentions(found: DataFrame, text: str, key: str) -> DataFrame:
    """key, entities, words: of each different text with entities, hashes of them and its terms."""

    def name(span: Column, kind: str) -> Column:
        return F.xxhash64(F.lit(kind), F.lower(_cut("cuts", span["start"], span["end"])))

    # Texts without entities go last: a filter on the spans would be pushed below them, and search each text again.
    rows = _with_words(found.withColumn(text, F.when(_some(), F.col(text))), text).withColumn("cuts", _pieces(text, _some()))
    rows = rows.select(key, F.array_distinct(F.concat(*(_each(k, name) for k in KINDS))).alias("entities"), "words")
    rows = rows.groupBy(key).agg(F.first(F.struct("entities", "words")).alias("v"))  # equal texts have equal ones
    return rows.select(key, "v.*").filter(F.size("entities") > 0)


def _ln_choose(n: Column, k: Column) -> Column:
    """ln C(n, k) by Stirling's series, to about 0.001."""

    def ln_factorial(x: Column) -> Column:
        y = F.greatest(x, F.lit(1)).cast("double")
        return F.when(x < 2, F.lit(0.0)).otherwise(y * F.ln(y) - y + F.ln(y * 2 * math.pi) / 2 + 1 / (12 * y))

    return ln_factorial(n) - ln_factorial(k) - ln_factorial(n - k)


def disclosing_terms(mentions: DataFrame, found: DataFrame, generalise: float = GENERALISE, chance: float = CHANCE) -> DataFrame:
    """key, term, disclosed: of each text, its terms at or above the threshold for an entity in it, and the most of these shares.

    `found` has all documents' `key` (a hash of the text), `text` and spans; `mentions` is from _mentions() over them. Counts are of
    different texts, so copies weigh once.
    """
    texts = found.select("key").distinct().count()
    # One row of each text goes on, so that its terms are counted plainly, in the tasks that have them.
    words = _with_words(found, "text").groupBy("key").agg(F.first("words").alias("words"))
    # A plain explode makes Spark filter on the array below, and so search each text again.
    each = words.select("key", F.explode_outer("words").alias("term")).filter("term IS NOT NULL")
    sign = F.bit_xor(F.xxhash64("key"))
    with_term = stored(each.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"), sign.alias("t_sign")))
    terms = with_term.count()
    nothing = found.sparkSession.createDataFrame([], "key long, term string, disclosed double")
    if not terms:
        return nothing

    def expected(n_both: Column, *choices: Column) -> Column:
        return F.lit(math.log(terms)) + sum(choices, F.lit(0.0)) - _ln_choose(F.lit(texts).cast("long"), n_both)

    def share(n_both: Column) -> Column:
        """How much of the entity a term with so many texts in common discloses."""
        shared = F.log2(n_both * F.lit(float(texts)) / (F.col("n_entity") * F.col("n_term")))
        own = F.log2(F.lit(float(texts)) / F.col("n_entity"))
        return F.when(own > 0, shared / own).otherwise(F.lit(0.0))

    unlikely = F.lit(math.log(chance))
    held = mentions.select("key", F.explode("entities").alias("entity"))
    with_entity = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"), sign.alias("e_sign"))
    # No pair has more texts in common than its entity has texts: those below can't pass, whatever their terms are.
    with_entity = stored(with_entity.withColumn("least", F.least("n_entity", F.lit(texts // 2))).filter(expected(F.col("least"), F.lit(0.0)) <= unlikely).drop("least"))
    # Nor has it more than its term has, so a term in more texts than this discloses too little of any entity.
    room = F.col("n_entity") * F.pow(F.lit(float(texts)) / F.col("n_entity"), F.lit(1 - generalise))
    most = with_entity.agg(F.max(room)).first()[0]
    if most is None:
        return nothing
    # Entities of the same texts, and terms of the same texts, are worked out as one, so that a text with very many of both is
    # no product of them. What is compared is the 64-bit hashes of the texts, combined, and their number.
    e_class, t_class = ["n_entity", "e_sign"], ["n_term", "t_sign"]
    entities = stored(held.join(with_entity, "entity").select("key", *e_class).distinct())
    wanted = mentions.join(entities.select("key").distinct(), "key", "left_semi").select("key", F.explode("words").alias("term"))
    near = stored(wanted.join(with_term.filter(F.col("n_term") <= most * (1 + 1e-9)), "term").select("key", "term", *t_class))
    close = entities.join(near.select("key", *t_class).distinct(), "key").filter(share(F.least("n_entity", "n_term")) >= generalise - 1e-9)
    known = close.groupBy(*e_class, *t_class).agg(F.count(F.lit(1)).alias("n_both")).withColumn("disclosed", share(F.col("n_both")))
    n = F.col("n_both")
    significant = expected(n, _ln_choose(F.col("n_entity"), n), _ln_choose(F.col("n_term"), n)) <= unlikely
    bad = stored(known.filter((F.col("disclosed") >= generalise) & significant).select(*e_class, *t_class, "disclosed"))
    in_texts = entities.join(bad, e_class).groupBy("key", *t_class).agg(F.max("disclosed").alias("disclosed"))
    return near.join(in_texts, ["key", *t_class]).groupBy("key", "term").agg(F.max("disclosed").alias("disclosed"))


def _read(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))


def _found(docs: DataFrame, id_column: str, text_column: str, generalise: float, chance: float) -> tuple[DataFrame, DataFrame]:
    """All rows' base spans, without texts; and the terms to be sanitised in each text: key, terms, removed."""
    read = _read(docs, id_column, text_column)
    with_entities = _with_entities(read, "text")
    mentions = stored(_mentions(with_entities, "text", "key"))
    held = disclosing_terms(mentions, with_entities, generalise, chance)
    # The terms of one text; no more than it has.
    terms = held.groupBy("key").agg(
        F.collect_list("term").alias("terms"),
        F.collect_list(F.when(F.col("disclosed") >= REMOVE, F.col("term"))).alias("removed"),
    )
    return with_entities, stored(terms)


def entity_spans(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", generalise: float = GENERALISE, chance: float = CHANCE
) -> DataFrame:
    """Of every row: doc_id, an array of (start, end) for each of KINDS, and one for `term`, in code points, end exclusive.

    Null texts count as empty; empty texts have no spans. Rows with equal ids or texts are each returned. A term
    is a run of two or more letters and digits; it is marked wherever it stands in a text that holds the entity it discloses.
    """
    base, terms = _found(docs, id_column, text_column, generalise, chance)
    base = base.select("doc_id", "key", *KINDS)
    marked = _with_terms(_read(docs, id_column, text_column).select("key", "text").join(terms, "key"))
    marked = stored(marked.groupBy("key").agg(F.first("term").alias("term")))  # equal texts have equal spans
    none = F.array().cast(_SPANS)
    return base.join(marked, "key", "left").select("doc_id", *KINDS, F.coalesce("term", none).alias("term"))


def _with_terms(df: DataFrame) -> DataFrame:
    sought = F.col("terms").isNotNull()
    return _placed(df, "term", _TERM, "text", sought, lambda m: F.array_contains("terms", F.lower(m)))


def span_text(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of all spans, in the order given and by start, joined by commas."""
    parts = (_each(k, lambda s, k: F.concat(F.lit(f"{k}:"), s["start"], F.lit(":"), s["end"])) for k in kinds)
    return F.concat_ws(",", *parts)


def sanitised(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", generalise: float = GENERALISE, chance: float = CHANCE
) -> DataFrame:
    """The documents with each entity replaced by its kind in brackets, and terms that disclose one generalised or removed.

    All other columns are kept; a column n_chars is set to the new length. Where spans overlap they are
    replaced as one, by the tag of the one that begins first, of those the longest, and the tags of those that reach beyond what
    is replaced before them. Null texts stay null.
    """
    spoken = {name: f"in {i}" for i, name in enumerate(docs.columns)}
    base, terms = _found(docs, id_column, text_column, generalise, chance)
    body = docs.toDF(*spoken.values())
    text = F.coalesce(F.col(spoken[text_column]).cast("string"), F.lit(""))
    body = body.withColumn("text", text).withColumn("key", F.xxhash64("text")).join(terms, "key", "left")
    body = _with_terms(_with_entities(body, "text"))
    body = body.withColumn("pieces", _pieces("text", _some() | (F.size("term") > 0)))
    tags = [_each(k, lambda s, k: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), F.lit(f"[{k.upper()}]").alias("tag"))) for k in KINDS]
    word = F.transform(
        "term",
        lambda s: F.struct(
            s["start"].alias("start"),
            (-s["end"]).alias("back"),
            F.when(F.array_contains("removed", F.lower(_cut("pieces", s["start"], s["end"]))), F.lit(""))
            .when(_cut("pieces", s["start"], s["start"] + 1).rlike("[0-9]"), F.lit("[NUMBER]"))
            .when(_cut("pieces", s["start"], s["start"] + 1).rlike(r"\p{Lu}"), F.lit("[NAME]"))
            .otherwise(F.lit("[WORD]"))
            .alias("tag"),
        ),
    )
    body = body.withColumn("spans", F.array_sort(F.concat(*tags, word)))
    body = body.withColumn("ends", F.transform("spans", lambda s: -s["back"])).withColumn("reach", _before("ends", _larger))

    def piece(s: Column, i: Column) -> Column:
        """What stands for a span and the text before it; null for one that is replaced already."""
        at = F.get("reach", i)
        told = F.when(s["start"] >= at, F.concat(_cut("pieces", at, s["start"]), s["tag"])).otherwise(s["tag"])
        return F.when(F.get("ends", i) > at, told)

    parts, at = F.transform("spans", piece), F.array_max("ends")
    body = body.withColumn("done", F.when(F.size("spans") > 0, F.struct(at.alias("at"), parts.alias("parts"))))
    rest = F.substring(F.col("text"), F.col("done")["at"] + 1, F.length("text"))
    clean = F.when(F.col("done").isNotNull(), F.concat(F.concat_ws("", F.col("done")["parts"]), rest)).otherwise(F.col(spoken[text_column]))
    body = body.withColumn("clean", clean)
    out = []
    for field in docs.schema:
        value = F.col(spoken[field.name])
        if field.name == text_column:
            value = F.col("clean")
        elif field.name == "n_chars":
            value = F.when(F.col("done").isNotNull(), F.length("clean")).otherwise(value).cast(field.dataType)
        out.append(value.alias(field.name))
    return body.select(*out)
