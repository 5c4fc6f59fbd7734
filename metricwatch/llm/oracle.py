"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from metricwatch.llm.decontamination import PERCENT as CONTAINED
from metricwatch.llm.near import PERCENT as NEAR
from metricwatch.llm.text import SHINGLE_WORDS

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{LETTERS}', '{LETTERS.lower()}'), '[^\x20\x09-\x0D]+')"


def shingle_sets(name: str, table: str, key: str) -> str:
    """CTEs `name`_words (key, w) and `name` (key, shingle), one row per distinct shingle."""
    k = SHINGLE_WORDS
    return f"""
    {name}_words AS (SELECT {key}, {words("text")} AS w FROM {table}),
    {name} AS (
      SELECT {key}, unnest(list_distinct(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' ')) END)) AS shingle
      FROM {name}_words)"""


def near_copies(table: str) -> str:
    """CTEs that end in near_groups (doc_id, n_shingles, component_id)."""
    return f"""
    {shingle_sets("near_set", table, "doc_id")},
    near_size AS (SELECT doc_id, count(*) AS n FROM near_set GROUP BY ALL),
    near_met AS (
      SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
      FROM near_set a JOIN near_set b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
    near_link AS (
      SELECT x, y FROM near_met m JOIN near_size a ON a.doc_id = x JOIN near_size b ON b.doc_id = y
      WHERE 100 * m.n >= {NEAR} * (a.n + b.n - m.n)),
    near_reach AS (
      SELECT x, x AS y FROM near_link UNION SELECT r.x, l.y FROM near_reach r JOIN near_link l ON l.x = r.y),
    near_least AS (SELECT x, min(y) AS least FROM near_reach GROUP BY x),
    near_groups AS (
      SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.least, d.doc_id) AS component_id
      FROM {table} d LEFT JOIN near_size s ON s.doc_id = d.doc_id LEFT JOIN near_least l ON l.x = d.doc_id)"""


def leaks(table: str) -> str:
    """CTEs that end in leak_pairs (doc_id, item_id, n_shingles, overlap, containment)."""
    return f"""
    {shingle_sets("leak_item", "benchmark", "item_id")},
    {shingle_sets("leak_doc", table, "doc_id")},
    leak_size AS (SELECT item_id, count(*) AS n FROM leak_item GROUP BY ALL),
    leak_pairs AS (
      SELECT doc_id, item_id, any_value(n) AS n_shingles, count(*) AS overlap, count(*)::DOUBLE / any_value(n) AS containment
      FROM leak_item JOIN leak_size USING (item_id) JOIN leak_doc USING (shingle)
      GROUP BY doc_id, item_id HAVING 100 * count(*) >= {CONTAINED} * any_value(n))"""


ORACLE: dict[str, str] = {
    "op7_benchmark_containment": f"WITH {leaks('documents')} SELECT * FROM leak_pairs",
    "op10_near_copies": f"WITH RECURSIVE {near_copies('documents')} SELECT * FROM near_groups",
}
