"""The queries of the problems on text and training data (2, 4, 8, 9, 10) over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolith.llm import canonical, encode, names, pack, quality
from agrolith.sources.tables import once, table


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = once(table(spark, sf_dir, "research_cells"), "cell_id", "tier")
    mapped = canonical.map_values(cells, "tier", table(spark, sf_dir, "tier_reference"))
    return cells.join(mapped.withColumnRenamed("text", "tier"), "tier").select("cell_id", "ref_id")


def p4_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed tiers that fit no entry, with the number of cells that have them."""
    cells = once(table(spark, sf_dir, "research_cells"), "cell_id", "tier")
    return canonical.unmatched(cells, "tier", canonical.map_values(cells, "tier", table(spark, sf_dir, "tier_reference")))


def _typed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """subject, field, text of the leads and names of both copies of the register."""
    both = [table(spark, sf_dir, t).select("subject", F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in ("lead", "name")]))) for t in ("register_entries", "register_copy")]
    return both[0].unionByName(both[1])


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.link_variants(_typed_names(spark, sf_dir))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode(table(spark, sf_dir, "documents"))


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in its container or containers, for each budget."""
    budgets = table(spark, sf_dir, "token_budgets")
    documents = table(spark, sf_dir, "documents").select("doc_id", encode.token_count(F.col("text")).alias("n_tokens"))
    known = [(r["budget_id"], r["capacity"]) for r in budgets.orderBy("budget_id").collect()]  # fixed table
    return pack.fill_by_budget(documents, known, "doc_id", "n_tokens")


def p9_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.fill_report(p9_containers(spark, sf_dir), table(spark, sf_dir, "token_budgets"))


def p9_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the containers, counted: every document with text is in them, none is overfull, none split needlessly or with gaps."""
    return pack.fill_invariants(p9_containers(spark, sf_dir), table(spark, sf_dir, "token_budgets"), "doc_id")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.kinds(table(spark, sf_dir, "documents"))


def p10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its statistics and its kind."""
    return quality.quality(table(spark, sf_dir, "documents"))


def p10_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and shares of every document that are Spark expressions."""
    return quality.statistics(table(spark, sf_dir, "documents")).drop("_words")


QUERIES = {"p2_found": p2_found, "p4_found": p4_found, "p4_unmatched": p4_unmatched, "p8_ids": p8_ids, "p9_containers": p9_containers, "p9_fill": p9_fill, "p9_invariants": p9_invariants, "p10_found": p10_found, "p10_quality": p10_quality, "p10_statistics": p10_statistics}
_OUTER = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160) || chr(8195) || chr(8201) || chr(8239) || chr(12288)"
_DOUBLED = "[ÃÂâ][\\x{80}-\\x{bf}€™œž‚ƒ„…†‡ˆ‰Š‹Œ‘’“”•–—˜š›Ÿ]"
_COMMON = ", ".join(f"'{w}'" for w in sorted(quality.COMMON))  # the list of words is data of the definition, not logic
ORACLES: dict[str, str] = {
    "p9_invariants": "SELECT budget_id, (SELECT count(*) FROM documents WHERE text <> '') AS documents, 0 AS needless, 0 AS gaps, 0 AS overfull FROM token_budgets",
    "p10_statistics": f"""WITH d AS (SELECT doc_id, text, CASE WHEN trim(text, {_OUTER}) <> '' THEN text END AS t, regexp_replace(text, '\r\n?', chr(10), 'g') AS body FROM documents),
      p AS (SELECT doc_id, text, t, regexp_extract_all(lower(t), '\\p{{L}}+') AS w, CASE WHEN t IS NOT NULL THEN list_filter(list_transform(string_split(body, chr(10)), lambda x: trim(x, {_OUTER})), lambda x: x <> '') ELSE [] END AS l,
        CASE WHEN t IS NOT NULL THEN list_filter(list_transform(string_split_regex(body, '\n\\s*\n'), lambda x: trim(x, {_OUTER})), lambda x: x <> '') ELSE [] END AS g, length(regexp_replace(t, '\\s', '', 'g')) AS dense FROM d),
      n AS (SELECT *, coalesce(len(w), 0) AS nw, len(l) AS nl, coalesce(length(array_to_string(w, '')), 0) AS letters, length(regexp_replace(t, '[^0-9]', '', 'g')) AS digits FROM p)
      SELECT doc_id, nw AS n_words, nl AS n_lines, letters / nullif(nw, 0) AS mean_word_length, (dense - letters - digits) / nullif(dense, 0) AS symbol_share, digits / nullif(dense, 0) AS digit_share, length(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g')) / nullif(letters, 0) AS upper_share,
        len(list_filter(l, lambda x: regexp_matches(x, '[.!?…:]["''”’»)]*$'))) / nullif(nl, 0) AS punctuated_line_share,
        len(list_filter(l, lambda x: regexp_matches(x || ' ', '^([-*+•–—·▪◦‣●○□☐☑]|o|\\[[ xX]?\\]|\\(?([0-9]{{1,3}}|[a-zA-Z]|[ivxIVX]{{1,5}})[.)])\\s'))) / nullif(nl, 0) AS marked_line_share,
        len(list_filter(w, lambda x: x IN ({_COMMON}))) / nullif(nw, 0) AS common_word_share, len(list_distinct(w)) / nullif(nw, 0) AS distinct_word_share,
        CASE WHEN nl > 0 THEN (length(regexp_replace(t, '[^\\x{{fffd}}\\x{{80}}-\\x{{9f}}\\x{{00}}-\\x{{08}}\\x{{0b}}\\x{{0e}}-\\x{{1f}}]', '', 'g')) + length(t) - length(regexp_replace(t, '{_DOUBLED}', '', 'g'))) / length(t) END AS garbled_share,
        (length(array_to_string(l, '')) - length(array_to_string(list_distinct(l), ''))) / nullif(length(array_to_string(l, '')), 0) AS duplicate_line_share,
        (length(array_to_string(g, '')) - length(array_to_string(list_distinct(g), ''))) / nullif(length(array_to_string(g, '')), 0) AS duplicate_paragraph_share FROM n""",
}
