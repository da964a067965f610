"""The queries of the general data problems (1, 3, 5, 6, 7) over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolith.operators import copydiff, drift, orphans, packed, units
from agrolith.sources.tables import once, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    census, register = table(spark, sf_dir, "indicator_census"), table(spark, sf_dir, "register_entries")
    indicators, codes = table(spark, sf_dir, "indicators"), table(spark, sf_dir, "use_cases")
    use_cases = packed.code_dictionary((codes, "code"))
    census_items = packed.unpack(census, "indicator_census", "census_id", {
        "merged_into": ("codes", packed.code_dictionary((indicators, "indicator_id"))),
        "use_case_areas": ("codes", use_cases),
        "dar_steps_served": ("codes", use_cases),
    })
    register_items = packed.unpack(register, "register_entries", "entry_id", {"uc": ("phrases", packed.phrase_dictionary(register, "uc"))})
    return census_items.unionByName(register_items)


def p1_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of the census fields alone, which are codes."""
    return p1_found(spark, sf_dir).where("table_name = 'indicator_census'")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = once(table(spark, sf_dir, "research_cells"), "cell_id", "indicator_id", "value", "value_unit", "notes")
    indicators = table(spark, sf_dir, "indicators").where("unit is not null").select("indicator_id", F.col("unit").alias("default_unit"))
    rows = cells.join(indicators, "indicator_id")
    out = units.normalise_units(rows, table(spark, sf_dir, "unit_factors"), "cell_id", "value", "value_unit", "notes", "default_unit")
    milli = F.floor(F.col("base_value").try_cast("decimal(32,9)") * 1000 + F.lit("0.5").cast("decimal(3,1)")).try_cast("bigint")
    # a value that is no bigint in thousandths has no place in the result
    return out.where("abs(base_value) < 9.2e15").select("cell_id", milli.alias("value_milli"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name, other, key in (("research_cells", "research_cells_copy", "cell_id"), ("register_entries", "register_copy", "entry_id")):
        found = copydiff.diff_copies(table(spark, sf_dir, name), table(spark, sf_dir, other), key)
        one = found.select(F.lit(name).alias("table_name"), "row_key", "kind", "field")
        out = one if out is None else out.unionByName(one)
    return out


def _references(df: DataFrame, key: str, at: str, fields: tuple[str, ...], prefix: str = "") -> DataFrame:
    """table-less rows row_key, field, ref_key, at of the codes packed in the fields."""
    # the joining words are the ones that stand between two codes in lower case
    cut = lambda c: F.regexp_replace(F.regexp_replace(F.col(c), r"^\s*(?i:uc)\s*:", ""), r"(?<=[\w.\-]\s{1,3})(?:and|or|und|et|y)(?=\s+\w)", " ")
    items = lambda c: F.regexp_extract_all(F.upper(cut(c)), F.lit(r"([\p{L}\p{N}](?:[\p{L}\p{N}.\-]*[\p{L}\p{N}])?)"), 1)
    packed_rows = df.where(" or ".join(f"coalesce({c}, '') <> ''" for c in fields)).select(F.col(key).alias("row_key"), F.col(at).alias("at"), F.inline(F.array(*[F.struct(F.lit(c).alias("field"), items(c).alias("keys")) for c in fields])))
    return packed_rows.select("row_key", "at", "field", F.explode("keys").alias("ref_key"))


def p6_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orphan references row by row: table_name, field, row_key, ref_key, state, at."""
    indicators = table(spark, sf_dir, "indicators").select(F.lit("indicators").alias("list"), F.upper("indicator_id").alias("ref_key"), "added_on", "retired_on")
    codes = table(spark, sf_dir, "use_cases").select(F.lit("use_cases").alias("list"), F.upper("code").alias("ref_key"), "added_on", "retired_on")
    census = _references(table(spark, sf_dir, "indicator_census"), "census_id", "decided_at", ("merged_into", "prerequisite"))
    observed = _references(table(spark, sf_dir, "observations"), "obs_id", "observed_at", ("prereq",))
    refs = census.withColumn("table_name", F.lit("indicator_census")).unionByName(observed.withColumn("table_name", F.lit("observations")))
    refs = refs.withColumn("list", F.when(F.col("field") == "merged_into", "indicators").otherwise("use_cases"))
    return orphans.orphan_references(refs, indicators.unionByName(codes), ["list", "ref_key"], at="at").drop("list")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_orphans(spark, sf_dir).select("table_name", "field", "row_key", "ref_key", "state", F.date_format("at", "yyyy-MM").alias("ym")).distinct()


def p6_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan references per table, field, month and state."""
    return orphans.by_table_and_period(p6_found(spark, sf_dir), "table_name", "field", "ym")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.schema_changes(table(spark, sf_dir, "raw_records").select("feed", "file_no", "payload"))


def p7_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files of all feeds in one table with one schema."""
    return drift.consistent_table(table(spark, sf_dir, "raw_records").select("feed", "file_no", "payload"))


QUERIES = {"p1_found": p1_found, "p1_codes": p1_codes, "p3_found": p3_found, "p5_found": p5_found, "p6_found": p6_found, "p6_by_month": p6_by_month, "p7_found": p7_found, "p7_table": p7_table}
def _diff_sql(main: str, copy: str, key: str, fields: tuple[str, ...]) -> str:
    a, b = (f"(SELECT DISTINCT {key}, {', '.join(fields)} FROM {t})" for t in (main, copy))
    cells = " UNION ALL ".join(f"SELECT '{main}', a.{key}, 'differs', '{f}' FROM {a} a JOIN {b} b ON a.{key} = b.{key} WHERE a.{f} IS DISTINCT FROM b.{f}" for f in fields)
    return f"""SELECT '{main}' AS table_name, {key} AS row_key, 'missing_in_copy' AS kind, '' AS field FROM {a} WHERE {key} NOT IN (SELECT {key} FROM {copy})
      UNION ALL SELECT '{main}', {key}, 'missing_in_main', '' FROM {b} WHERE {key} NOT IN (SELECT {key} FROM {main}) UNION ALL {cells}"""


def _orphan_sql(table_name: str, key: str, field: str, at: str, targets: str, target_key: str) -> str:
    items = f"unnest(regexp_extract_all(upper(regexp_replace(regexp_replace({field}, '^\\s*(?i:uc)\\s*:', ''), '\\b(and|or|und|et|y)\\b', ' ', 'g')), '[A-Z0-9](?:[A-Z0-9.-]*[A-Z0-9])?'))"
    return f"""SELECT DISTINCT '{table_name}' AS table_name, '{field}' AS field, row_key, ref_key, CASE WHEN t.k IS NULL THEN 'missing' WHEN retired_on <= at_time THEN 'deleted' ELSE 'late' END AS state, strftime(at_time, '%Y-%m') AS ym
      FROM (SELECT {key} AS row_key, {at} AS at_time, {items} AS ref_key FROM {table_name}) r LEFT JOIN (SELECT upper({target_key}) AS k, added_on, retired_on FROM {targets}) t ON t.k = r.ref_key
      WHERE t.k IS NULL OR retired_on <= at_time OR added_on > at_time"""


#: Problem 3 in SQL: each unit by a pattern of its own names, none of them taken from the operator.
_UNIT_PATTERNS = {
    "USD": r"us ?\$|usd|\$|u\.?s\.? dollars?|united states dollars?|dollars?", "XVD": r"xvd( \(local\))?", "QMR": r"qmr( \(local\))?", "XKL": r"xkl( \(local\))?", "QTN": r"qtn( \(local\))?",
    "kg/ha": r"(kgs?|kilos?|kilograms?) ?(/ ?|per )(ha|hectare)|kg ha-1", "t/ha": r"(t|mt|tonnes?|(metric )?tons?) ?(/ ?|per )(ha|hectare)|t ha-1", "q/ha": r"(q|qx|quintals?) ?(/ ?|per )(ha|hectare)|q ha-1", "lb/acre": r"(lbs?|pounds?) ?(/ ?|per )(ac|acre)",
    "%": r"%|per ?cent|pct|percentage|p\.?c|per hundred|(per|in) 100", "fraction": r"fraction|proportion|ratio( \(0-1\))?|share( of 1)?|\(0-1\)", "permille": r"‰|per ?mille|per mil|per thousand|per 1,?000|in 1000", "bp": r"bps?|basis points?",
    "ha": r"has?|hect|hectares?", "feddan": r"fed|feddans?", "acre": r"ac|acres?", "km2": r"km(2|²|\^2)|sq\.? ?km|square kilomet(er|re)s?",
    "t": r"t|mt|tonnes?|tons?|metric ton(ne)?s?", "kg": r"kgs?|kilos?|kilograms?", "q": r"q|qx|quintals?", "kt": r"kt|kiloton(ne)?s?",
    "mm": r"mm|millimet(er|re)s?", "cm": r"cm|centimet(er|re)s?", "inch": r"in|inch|inches", "m": r"m|met(er|re)s?", "km": r"kms?|kilomet(er|re)s?", "mile": r"mi|miles?", "metre": r"m|met(er|re)s?",
    "Mbit/s": r"mbit/s|mbps|megabits?( per second|/s)", "kbit/s": r"kbit/s|kbps|kilobits?( per second|/s)", "Gbit/s": r"gbit/s|gbps|gigabits?( per second|/s)", "MB/s": r"mb/s|mbytes?/s|megabytes?( per second|/s)",
    "kWh": r"kwh|kilowatt[ -]hours?", "MWh": r"mwh|megawatt[ -]hours?", "GWh": r"gwh|gigawatt[ -]hours?", "MJ": r"mj|megajoules?",
    "index100": r"index100|/ ?100|(out )?of 100( points)?|points?( \(0-100\))?|(on a )?0-100 scale|index 0 to 100", "index1": r"index1|/ ?1|(out )?of 1|(on a )?0-1 scale|index( 0 to 1| \(0-1\))",
    "index10": r"index10|/ ?10|(out )?of 10( points)?|points \(0-10\)|(on a )?0-10 scale|index 0 to 10", "persons": r"persons?|people|individuals?|farmers?|growers?",
    "days": r"d|days?|day\(s\)|calendar days?", "weeks": r"wks?|weeks?|week\(s\)", "hours": r"h|hrs?|hours?|hour\(s\)",
}


def _quantity_sql() -> str:
    """Problem 3 in SQL: every distinct spelling is held against the patterns; a remark is looked for as an opening phrase with a spelling and a stop behind it."""
    lit = lambda x: "'" + x.replace("'", "''") + "'"
    patterns = ", ".join(f"({lit(u)}, {lit(p)})" for u, p in _UNIT_PATTERNS.items())
    big = "thousands?|''000|000s|k|millions?|mio|mln|mn|m|billions?|bln|bn|trillions?|tn"
    any_unit = f"(?:(?:{big})(?: of)? ?)?(?:{'|'.join(_UNIT_PATTERNS.values())})|(?:{big})".replace("(", "(?:").replace("(?:?:", "(?:").replace("\\(?:", "\\(")
    digits = "".join(chr(z + i) for z in (0x660, 0x6F0, 0x966, 0x9E6, 0xFF10) for i in range(10))
    shown = lambda c: f"lower(trim(regexp_replace(translate({c}, '％’‘`´ʼ–—−＄٫٬{digits}', '%' || repeat('''', 5) || '---$.,' || repeat('0123456789', 5)), '[\\s\\x{{A0}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+', ' ', 'g')))"
    loose = "approximately|approx[.]?|about|around|roughly|nearly|almost|some|circa|ca[.]?|c[.]|estimated|est[.]?|~|≈|±|>=|<=|<|>|≥|≤|=|:|at least|up to|over|under|more than|less than|total of|total"
    parts = f"^(?:(?:{loose}) ?)*([^0-9(]*?) ?(?:(?:{loose}) ?)*([+-]?[0-9]+(?:[ ''][0-9]{{3}}|[.,][0-9]+)*) ?([^0-9].*)?$"
    brackets = " ?[(](?:(?:19|20)[0-9][0-9][^)]*|provisional|latest|estimate|revised|[a-z][a-z ]{{3,}})[)]$"
    brackets = brackets.replace("{{", "{").replace("}}", "}")
    clean = lambda c: f"trim(regexp_replace(regexp_replace(trim({c}), '([a-z²2])[.]$', '\\1'), ' ?[,;]$', ''))"
    return f"""WITH un(unit, pattern) AS (VALUES {patterns}), nm AS (SELECT quantity, factor, pattern FROM un JOIN unit_factors USING (unit)),
      c AS (SELECT DISTINCT cell_id, u.quantity, u.factor AS tf, {shown('value')} AS v, {clean(f"coalesce({shown('value_unit')}, '')")} AS field, coalesce({shown('notes')}, '') AS notes FROM research_cells JOIN indicators i USING (indicator_id) JOIN unit_factors u ON u.unit = i.unit WHERE value IS NOT NULL),
      p AS (SELECT *, regexp_extract(v, '{parts}', 1) AS ahead0, regexp_extract(v, '{parts}', 2) AS num, regexp_replace(regexp_replace(coalesce(regexp_extract(v, '{parts}', 3), ''), '{brackets}', ''), '{brackets}', '') AS after0,
        regexp_extract(notes, '(?:^|[.!?…] )(?:unit as published: |nb: |the source reports this in |figure given in )({any_unit})[.]?(?:, not converted)?[.](?: |$)', 1) AS remark FROM c WHERE regexp_matches(v, '{parts}')),
      s AS (SELECT cell_id, quantity, tf, num, {clean('ahead0')} AS ahead, {clean('after0')} AS after, field, {clean('remark')} AS remark FROM p),
      d AS (SELECT DISTINCT quantity, x FROM (SELECT quantity, unnest([ahead, after, field, remark]) AS x FROM s) WHERE x <> ''),
      e AS (SELECT quantity, x, regexp_extract(x, '^({big})(?:$|[^a-z])', 1) AS w, trim(regexp_replace(regexp_replace(x, '^({big})', ''), '^ of ', '')) AS y FROM d),
      f AS (SELECT *, CASE WHEN w IN ('thousand', 'thousands', '''000', '000s', 'k') THEN 1e3 WHEN w IN ('million', 'millions', 'mio', 'mln', 'mn', 'm') THEN 1e6 WHEN w IN ('billion', 'billions', 'bln', 'bn') THEN 1e9 WHEN w <> '' THEN 1e12 END AS big FROM e),
      g AS (SELECT f.quantity, f.x, max(a.factor) AS whole, max(b.factor) AS part, any_value(big) AS big, any_value(y) AS y FROM f LEFT JOIN nm a ON a.quantity = f.quantity AND regexp_full_match(f.x, a.pattern) LEFT JOIN nm b ON b.quantity = f.quantity AND f.w <> '' AND regexp_full_match(f.y, b.pattern) GROUP BY f.quantity, f.x),
      k AS (SELECT quantity, x, coalesce(whole, part) AS factor, CASE WHEN whole IS NOT NULL THEN 1 WHEN part IS NOT NULL OR y = '' THEN big END AS scale FROM g),
      q AS (SELECT cell_id, tf, replace(replace(num, ' ', ''), '''', '') AS a, ahead, after, ka.scale AS as_, ka.factor AS af, kb.scale AS bs, kb.factor AS bf, kf.factor AS ff, kf.scale AS fs, kr.factor AS rf, kr.scale AS rs FROM s
        LEFT JOIN k ka ON ka.quantity = s.quantity AND ka.x = after LEFT JOIN k kb ON kb.quantity = s.quantity AND kb.x = ahead LEFT JOIN k kf ON kf.quantity = s.quantity AND kf.x = field LEFT JOIN k kr ON kr.quantity = s.quantity AND kr.x = remark
        WHERE (after = '' OR ka.scale IS NOT NULL) AND (ahead = '' OR kb.scale IS NOT NULL)),
      t AS (SELECT *, coalesce(as_, 1) AS s1, coalesce(as_, 1) * coalesce(bs, 1) AS s2, coalesce(af, bf) AS xf, CASE WHEN regexp_matches(a, '[.][0-9]+,[0-9]+$') AND NOT regexp_matches(a, ',[0-9]{{3}}$') THEN replace(replace(a, '.', ''), ',', '.')
        WHEN regexp_matches(a, '[.].*[.]') THEN replace(replace(a, '.', ''), ',', '') WHEN regexp_matches(a, '^[+-]?[0-9]+(,[0-9]{{3}})+([.][0-9]+)?$') THEN replace(a, ',', '') ELSE replace(a, ',', '.') END AS n FROM q)
      SELECT cell_id, CAST(floor(try_cast(n AS decimal(20, 6)) * CAST(round(CASE WHEN ff IS NOT NULL AND xf IS NOT NULL AND s1 = fs THEN ff * fs WHEN ff IS NOT NULL THEN ff * fs * s2 WHEN xf IS NOT NULL THEN xf * s2 WHEN rf IS NOT NULL THEN rf * rs * s2 ELSE tf * s2 END / tf, 8) AS decimal(18, 8)) * 1000 + 0.5) AS BIGINT) AS value_milli FROM t"""


#: Problem 7 in SQL: spans by seq, mutual best renamings of one round, lineages by a recursive query.
_DRIFT = """WITH RECURSIVE v AS (SELECT DISTINCT feed, file_no, payload FROM raw_records WHERE feed IS NOT NULL AND file_no IS NOT NULL AND json_valid(payload)),
  o AS (SELECT feed, file_no, payload, json_extract_string(payload, '$.id') AS rid FROM v WHERE json_type(payload) = 'OBJECT'),
  k AS (SELECT feed, file_no, rid, payload, unnest(json_keys(payload)) AS field FROM o),
  c AS (SELECT feed, file_no, rid, field, json_extract(payload, '$."' || field || '"') AS val FROM k),
  y AS (SELECT feed, file_no, field, CASE json_type(val) WHEN 'NULL' THEN NULL WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' ELSE 'number' END AS type FROM c),
  f AS (SELECT feed, file_no, field, type FROM (SELECT feed, file_no, field, type, count(*) AS n FROM y GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY feed, file_no, field ORDER BY type IS NULL, n DESC, type) = 1),
  q AS (SELECT feed, file_no, row_number() OVER (PARTITION BY feed ORDER BY file_no) AS seq FROM (SELECT DISTINCT feed, file_no FROM f)),
  g AS (SELECT f.*, seq, seq - row_number() OVER (PARTITION BY feed, field ORDER BY seq) AS island, max(seq) OVER (PARTITION BY feed) AS last FROM f JOIN q USING (feed, file_no)),
  s AS (SELECT feed, field, min(seq) AS b, max(seq) AS e, any_value(last) AS last FROM g GROUP BY feed, field, island),
  w AS (SELECT DISTINCT c.feed, seq, field, rid, val::VARCHAR AS val FROM c JOIN q USING (feed, file_no) WHERE rid IS NOT NULL AND json_type(val) <> 'NULL'),
  m AS (SELECT x.feed, z.b AS seq, x.field AS old, z.field AS new, count(*) AS n, count(*) FILTER (WHERE a.val = d.val) AS same FROM s x JOIN s z ON x.feed = z.feed AND x.e + 1 = z.b
    JOIN w a ON a.feed = x.feed AND a.seq = x.e AND a.field = x.field JOIN w d ON d.feed = z.feed AND d.seq = z.b AND d.field = z.field AND d.rid = a.rid GROUP BY ALL HAVING same * 2 > n),
  r AS (SELECT feed, seq, old, new FROM m QUALIFY row_number() OVER (PARTITION BY feed, seq, old ORDER BY same / n DESC, same DESC, old, new) = 1 AND row_number() OVER (PARTITION BY feed, seq, new ORDER BY same / n DESC, same DESC, old, new) = 1),
  h AS (SELECT s.*, r.old, lag(e) OVER (PARTITION BY s.feed, field ORDER BY b) AS before FROM s LEFT JOIN r ON r.feed = s.feed AND r.seq = s.b AND r.new = s.field),
  u AS (SELECT h.*, CASE WHEN h.old IS NOT NULL THEN h.old WHEN before IS NOT NULL AND x.seq IS NULL THEN field END AS up, CASE WHEN h.old IS NOT NULL THEN b - 1 ELSE before END AS up_end FROM h LEFT JOIN r x ON x.feed = h.feed AND x.seq = h.before + 1 AND x.old = h.field),
  t(feed, field, b, e, root, start) AS (SELECT feed, field, b, e, field, b FROM u WHERE up IS NULL UNION ALL SELECT u.feed, u.field, u.b, u.e, t.root, t.start FROM u JOIN t ON t.feed = u.feed AND t.field = u.up AND t.e = u.up_end)
"""
_DRIFT_CHANGES = _DRIFT + """, p AS (SELECT feed, seq, 'renamed' AS change_kind, old AS field, new AS new_field FROM r
    UNION ALL SELECT feed, e + 1, 'removed', field, '' FROM s WHERE e < last AND NOT EXISTS (SELECT 1 FROM r WHERE r.feed = s.feed AND r.seq = s.e + 1 AND r.old = s.field)
    UNION ALL SELECT feed, b, 'added', field, '' FROM s WHERE b > 1 AND NOT EXISTS (SELECT 1 FROM r WHERE r.feed = s.feed AND r.seq = s.b AND r.new = s.field)
    UNION ALL SELECT feed, seq, 'retyped', field, '' FROM (SELECT t.feed, g.seq, g.field, g.type, lag(g.type) OVER (PARTITION BY t.feed, root, start ORDER BY g.seq, g.field) AS was FROM t JOIN g ON g.feed = t.feed AND g.field = t.field AND g.seq BETWEEN t.b AND t.e WHERE g.type IS NOT NULL) WHERE was <> type)
  SELECT p.feed, file_no, change_kind, field, new_field FROM p JOIN q USING (feed, seq)"""


_P6 = " UNION ALL ".join((
    _orphan_sql("indicator_census", "census_id", "merged_into", "decided_at", "indicators", "indicator_id"),
    _orphan_sql("indicator_census", "census_id", "prerequisite", "decided_at", "use_cases", "code"),
    _orphan_sql("observations", "obs_id", "prereq", "observed_at", "use_cases", "code"),
))
ORACLES = {
    "p5_found": _diff_sql("research_cells", "research_cells_copy", "cell_id", ("subject", "indicator_id", "value_type", "value", "year", "tier", "presence_rung", "quality_evidence"))
    + " UNION ALL " + _diff_sql("register_entries", "register_copy", "entry_id", ("run_id", "subject", "name", "lead", "uc", "status", "scale", "funding", "results", "results_tier", "overlap", "tier", "src", "src_url", "verification_note")),
    "p3_found": _quantity_sql(),
    "p1_codes": " UNION ALL ".join(f"""SELECT 'indicator_census' AS table_name, '{f}' AS field, row_key, CAST(generate_subscripts(items, 1) AS INTEGER) AS pos, unnest(items) AS item FROM (
      SELECT census_id AS row_key, list_filter(regexp_extract_all({f}, '[\\p{{L}}\\p{{N}}]([\\p{{L}}\\p{{N}}.-]*[\\p{{L}}\\p{{N}}])?'), lambda x: NOT regexp_full_match(x, '[a-z]+')) AS items FROM (SELECT DISTINCT census_id, {f} FROM indicator_census))""" for f in ("merged_into", "use_case_areas", "dar_steps_served")),
    "p6_found": _P6,
    "p7_found": _DRIFT_CHANGES,
    "p6_by_month": f"SELECT table_name, field, ym, state, count(*) AS orphans FROM ({_P6}) GROUP BY ALL",
}
