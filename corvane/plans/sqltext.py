"""SQL fragments for the oracles, written for DuckDB and independent of the Spark code."""

from __future__ import annotations

JOINER = "chr(57344)"
WORDS = r"[\p{L}\p{M}\p{N}_]+"


def keep_together(expr: str) -> str:
    """Mark the inner characters that hold two letters or two digits together.  Twice, because
    neighbouring matches share a character."""
    for _ in range(2):
        expr = (rf"regexp_replace({expr}, '(\p{{L}})([.:''’·])(\p{{L}})', "
                rf"'\1' || {JOINER} || '\2' || {JOINER} || '\3', 'g')")
        expr = (rf"regexp_replace({expr}, '(\p{{N}})([.,;''’])(\p{{N}})', "
                rf"'\1' || {JOINER} || '\2' || {JOINER} || '\3', 'g')")
    return expr


def tokens(expr: str) -> str:
    """Standard tokens of a text expression as a list."""
    pattern = rf"'{WORDS}(?:' || {JOINER} || '.' || {JOINER} || '{WORDS})*'"
    return (f"list_transform(regexp_extract_all({keep_together(f'lower({expr})')}, {pattern}), "
            f"lambda t: replace(t, {JOINER}, ''))")


def title_tokens(expr: str) -> str:
    return (f"flatten(list_transform({tokens(expr)}, lambda t: regexp_extract_all("
            r"regexp_replace(t, '[''’]s$', ''), '[\p{L}\p{M}]+|\p{N}+')))")


TITLE = "split_part(text, chr(10), 1)"
ABSTRACT = f"substr(text, length({TITLE}) + 2)"


def papers_cte(fields: dict[str, str], source: str = "documents") -> str:
    """tok(doc_id, field, toks), tf, dl, st and df over a table with doc_id."""
    parts = " UNION ALL ".join(
        f"SELECT doc_id, '{name}' AS field, {tokens(expr)} AS toks FROM {source}"
        for name, expr in fields.items())
    return f"""
tok AS ({parts}),
occ AS (SELECT doc_id, field, unnest(toks) AS term,
               generate_subscripts(toks, 1) - 1 AS pos FROM tok),
tf AS (SELECT doc_id, field, term, count(*) AS tf FROM occ GROUP BY ALL),
dl AS (SELECT doc_id, field, len(toks) AS dl FROM tok WHERE len(toks) > 0),
st AS (SELECT field, count(*) AS n, avg(dl) AS a FROM dl GROUP BY field),
df AS (SELECT field, term, count(*) AS df FROM tf GROUP BY ALL)"""


def clauses_cte(parts: dict[str, str], source: str = "benchmark", query_id: str = "item_id") -> str:
    """qt(query_id, clause, field, term, qtf); ``parts`` maps a field to its token list SQL."""
    union = " UNION ALL ".join(
        f"SELECT {query_id} AS query_id, {i} AS clause, '{name}' AS field, "
        f"unnest({toks}) AS term FROM {source}"
        for i, (name, toks) in enumerate(parts.items()))
    return f"qt AS (SELECT query_id, clause, field, term, count(*) AS qtf FROM ({union}) GROUP BY ALL)"


CLAUSE_SCORES = """
cs AS (SELECT query_id, clause, field, doc_id,
              sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5))
                  * tf / (tf + 1.2 * (0.25 + 0.75 * dl / a))) AS score
       FROM qt JOIN tf USING (field, term) JOIN df USING (field, term)
       JOIN dl USING (field, doc_id) JOIN st USING (field) GROUP BY ALL)"""


def top(scores: str, k: int = 10) -> str:
    """SELECT of the k best documents per query from a table with query_id, doc_id, score."""
    return f"""SELECT query_id, CAST(rank AS BIGINT) AS rank, doc_id, score FROM (
  SELECT query_id, doc_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
  FROM (SELECT query_id, doc_id, round(score, 6) AS score FROM {scores}) r0) r1
WHERE rank <= {k}"""
