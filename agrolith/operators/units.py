"""Quantities recorded in different units: parse number, scale and unit with regular expressions, normalise the unit by a
join on an alias table, coalesce unit field, text, remark and default, then apply the factor. SQL expressions only.

Defined results: null, blank and wordy values (sentences, "n/a", "-") give no row; a value with an unknown unit word gives no
row; a value whose unit measures another quantity than the default unit gives no row, nor does one without default unit;
repeated rows give repeated results; ties don't occur, as every step is a function of the row; of several remarks in one text
the first counts. Texts of any length are read, in time in proportion to their length; a number of more than 28 digits, or with
more than eight hedging words in a row, is no quantity. Converted values have nine decimals,
and are exact to them below 10^14.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolith.session import checkpointed

#: Up to so many units their names are broadcast; a longer list is joined as Catalyst sees fit.
UNITS_BOUND = 500

#: Other names of the units, by the canonical name. Keys are compared in lower case, without outer blanks and
#: final full stop. A name that means different units by quantity is listed under each.
ALIASES: dict[str, tuple[str, ...]] = {
    "USD": ("usd", "us$", "us dollar", "us dollars", "u.s. dollar", "u.s. dollars", "dollar", "dollars", "$", "united states dollars"),
    "XVD": ("xvd", "xvd (local)"),
    "QMR": ("qmr", "qmr (local)"),
    "XKL": ("xkl", "xkl (local)"),
    "QTN": ("qtn", "qtn (local)"),
    "kg/ha": ("kg/ha", "kg / ha", "kg ha-1", "kg per ha", "kg per hectare", "kilos/ha", "kilos per hectare", "kilogram per hectare", "kilograms per hectare", "kgs/ha"),
    "t/ha": ("t/ha", "t / ha", "t ha-1", "t per ha", "tonnes/ha", "tonne/ha", "tons/ha", "tonnes per hectare", "tonnes per ha", "tons per hectare", "metric tons per ha", "metric tons per hectare", "mt/ha"),
    "q/ha": ("q/ha", "q ha-1", "qx/ha", "quintal/ha", "quintals/ha", "quintal per hectare", "quintals per hectare", "quintals per ha"),
    "lb/acre": ("lb/acre", "lb/ac", "lbs/acre", "lbs/ac", "lb per acre", "lbs per acre", "pounds/acre", "pounds per acre"),
    "%": ("%", "percent", "per cent", "pct", "percentage", "pc", "p.c", "per hundred", "per 100", "in 100"),
    "fraction": ("fraction", "proportion", "ratio", "ratio (0-1)", "share of 1", "(0-1)", "share"),
    "permille": ("permille", "per mille", "per mil", "per thousand", "per 1000", "per 1,000", "‰", "in 1000"),
    "bp": ("bp", "bps", "basis point", "basis points", "bp."),
    "ha": ("ha", "hectare", "hectares", "hect", "has"),
    "feddan": ("feddan", "feddans", "fed"),
    "acre": ("acre", "acres", "ac"),
    "km2": ("km2", "km²", "km^2", "sq km", "sq. km", "sqkm", "square km", "square kilometre", "square kilometres", "square kilometer", "square kilometers"),
    "t": ("t", "tonne", "tonnes", "ton", "tons", "metric ton", "metric tons", "metric tonnes", "mt"),
    "kg": ("kg", "kgs", "kilo", "kilos", "kilogram", "kilograms"),
    "q": ("q", "qx", "quintal", "quintals"),
    "kt": ("kt", "kilotonne", "kilotonnes", "kiloton", "kilotons"),
    "mm": ("mm", "millimetre", "millimetres", "millimeter", "millimeters"),
    "cm": ("cm", "centimetre", "centimetres", "centimeter", "centimeters"),
    "inch": ("inch", "inches", "in", '"'),
    "m": ("m", "metre", "metres", "meter", "meters"),
    "Mbit/s": ("mbit/s", "mbps", "mb/s (bits)", "megabit per second", "megabits per second", "megabits/s"),
    "kbit/s": ("kbit/s", "kbps", "kilobit per second", "kilobits per second", "kilobits/s"),
    "Gbit/s": ("gbit/s", "gbps", "gigabit per second", "gigabits per second", "gigabits/s"),
    "MB/s": ("mb/s", "mbyte/s", "mbytes/s", "megabyte per second", "megabytes per second", "megabytes/s"),
    "km": ("km", "kms", "kilometre", "kilometres", "kilometer", "kilometers"),
    "mile": ("mile", "miles", "mi"),
    "metre": ("m", "metre", "metres", "meter", "meters"),
    "kWh": ("kwh", "kilowatt hour", "kilowatt hours", "kilowatt-hour", "kilowatt-hours"),
    "MWh": ("mwh", "megawatt hour", "megawatt hours", "megawatt-hour", "megawatt-hours"),
    "GWh": ("gwh", "gigawatt hour", "gigawatt hours", "gigawatt-hour", "gigawatt-hours"),
    "MJ": ("mj", "megajoule", "megajoules"),
    "index100": ("index100", "/100", "/ 100", "of 100", "out of 100", "points", "point", "points (0-100)", "of 100 points", "0-100 scale", "on a 0-100 scale", "index 0 to 100"),
    "index1": ("index1", "/1", "of 1", "out of 1", "0-1 scale", "on a 0-1 scale", "index 0 to 1", "index (0-1)"),
    "index10": ("index10", "/10", "/ 10", "of 10", "out of 10", "of 10 points", "points (0-10)", "0-10 scale", "on a 0-10 scale", "index 0 to 10"),
    "persons": ("persons", "person", "people", "individuals", "individual", "farmers", "farmer", "growers", "grower"),
    "thousand persons": (),
    "million persons": (),
    "days": ("days", "day", "day(s)", "d", "calendar days", "calendar day"),
    "weeks": ("weeks", "week", "week(s)", "wk", "wks"),
    "hours": ("hours", "hour", "hour(s)", "h", "hr", "hrs"),
}

_BLANK = "[\\u00a0\\u2000-\\u200a\\u202f\\u205f\\u3000\\t]"
#: Digits of other scripts, read as 0 to 9: Arabic, Persian, Devanagari, Bengali, full width; and other forms of marks.
_DIGITS = "".join(chr(zero + i) for zero in (0x660, 0x6F0, 0x966, 0x9E6, 0xFF10) for i in range(10))
_FROM = "％’‘`´ʼ–—−＄٫٬" + _DIGITS
_TO = "%" + "'" * 5 + "---$.," + "0123456789" * (len(_DIGITS) // 10)
# no number that fits 38 digits has more groups; the bounds keep the matcher's depth small in endless texts
_NUMBER = r"\d{1,38}(?:[ ']\d{3}(?!\d)|[.,]\d{1,38}){0,14}"
#: Words that hedge a figure without changing it.
_HEDGE = r"(?:approx(?:imately)?\.?|about|around|roughly|nearly|almost|some|circa|ca\.?|c\.|est(?:imated)?\.?|~|≈|±|>=|<=|[<>≥≤=:]|at least|up to|over|under|more than|less than|total(?: of)?)"
#: Scale words before or in place of a unit.
_SCALES = {
    "thousand": 1e3, "thousands": 1e3, "'000": 1e3, "000s": 1e3, "k": 1e3, "million": 1e6, "millions": 1e6, "mio": 1e6, "mln": 1e6,
    "mn": 1e6, "m": 1e6, "billion": 1e9, "billions": 1e9, "bln": 1e9, "bn": 1e9, "trillion": 1e12, "trillions": 1e12, "tn": 1e12,
}
#: A remark in brackets at the end, brackets that belong to a unit's name aside.
_REMARK = r"\s*[(\[](?!0-1\)|0-10\)|0-100\)|s\)|local\)|bits\))[^()\[\]]*[)\]]$"
#: A remark on the unit: a sentence anywhere in the text, up to its stop. A stop inside a unit's name ("U.S. dollars") is followed by a small letter or stands between initials.
_NOTE = (
    r"(?:^|[.!?…][\"'”’)\]]*\s+|\n)\s*(?i:unit as published\s*:|nb\s*:|(?:the )?source reports this in|figures?(?: is| are)? given in|reported in|unit\s*:)\s*"
    r"([^\n;]+?)(?i:,\s*not converted)?\s*\.*(?=\s*$|\s*[\n;]|(?<=\.)(?<![A-Z]\.[A-Z]\.)\s+[\"'“‘(]?[\p{Lu}\d])"
)


def plain(text: Column) -> Column:
    """One form of blanks, apostrophes, dashes and full-width signs, lower case."""
    t = F.translate(F.regexp_replace(text, _BLANK, " "), _FROM, _TO)
    return F.lower(F.trim(F.regexp_replace(t, r"\s+", " ")))


def unit_key(text: Column) -> Column:
    """A unit's name as the alias table holds it."""
    return F.trim(F.regexp_replace(F.trim(text), r"(?<=[a-z²2])\.$", ""))


def number_value(text: Column) -> Column:
    """The number of a figure with grouping and decimal marks, as an exact decimal.

    A comma, blank or apostrophe before exactly three digits groups thousands, as do dots if there are several or a decimal
    comma follows; any other comma or dot is decimal.
    """
    t = F.regexp_replace(text, "[ ']", "")
    t = F.regexp_replace(t, r"\.(?=[\d.]*,\d+$)", "")  # dots before a decimal comma
    t = F.regexp_replace(t, r",(?=\d{3}(?!\d))", "")
    t = F.regexp_replace(t, r"\.(?=\d+\.)|(?<=\.\d{1,40})\.", "")  # several dots
    return F.translate(t, ",", ".").try_cast("decimal(38,10)")


_NAMES = "quantity string, key string, factor double, offset double, scale double"


def names_of(units: pd.DataFrame) -> pd.DataFrame:
    """quantity, key, factor, offset, scale of units (unit, quantity, factor, offset): each name alone and behind each scale word, and the scale words
    alone (factor null). Of equal keys a unit's own name comes first, then a name, then a scaled one, then a bare scale word; of equals the greater factor.
    """
    best: dict[tuple[str, str], tuple] = {}

    def add(rank: int, quantity: str, key: str, factor: float | None, offset: float, scale: float) -> None:
        order = (rank, -(factor or 0.0))
        if (quantity, key) not in best or order < best[quantity, key][0]:
            best[quantity, key] = (order, factor, offset, scale)

    for unit, quantity, factor, offset in units[["unit", "quantity", "factor", "offset"]].itertuples(index=False):
        for w, scale in _SCALES.items():
            add(3, quantity, w, None, 0.0, scale)
        for name in dict.fromkeys((unit.lower(), *ALIASES.get(unit, ()))):
            add(0 if name == unit.lower() else 1, quantity, name, factor, offset, 1.0)
            for w, scale in _SCALES.items():
                # a scale word ends where its letters end
                for sep in (" ", " of ", *([] if "a" <= name[:1] <= "z" else [""])):
                    add(2, quantity, f"{w}{sep}{name}", factor, offset, scale)
    rows = [(q, k, f, o, s) for (q, k), (_, f, o, s) in best.items()]
    return pd.DataFrame(rows, columns=["quantity", "key", "factor", "offset", "scale"]).astype({"factor": "float64", "offset": "float64", "scale": "float64"})


def unit_tables(factors: DataFrame, bound: int = UNITS_BOUND) -> tuple[DataFrame, DataFrame]:
    """The units (unit, quantity, factor, offset) and their names. Both are broadcast if there are no more than ``bound`` units, else computed by quantity and joined by shuffle.

    ``offset``: what is added after the factor, 0 unless the list of units has such a column.
    """
    offset = F.coalesce(F.col("offset").cast("double"), F.lit(0.0)) if "offset" in factors.columns else F.lit(0.0)
    units = factors.where("unit is not null and quantity is not null").select("unit", "quantity", F.col("factor").cast("double").alias("factor"), offset.alias("offset"))
    few = units.limit(bound + 1).toPandas()
    if len(few) > bound:
        return units, checkpointed(units.groupBy("quantity").applyInPandas(names_of, _NAMES))
    spark = factors.sparkSession
    local = lambda pdf: F.broadcast(spark.createDataFrame(pa.Table.from_pandas(pdf, preserve_index=False)))
    return local(few), local(names_of(few))


_FIGURE = r"^((?:" + _HEDGE + r"\s*){0,8})([^\d(]*?)\s*((?:" + _HEDGE + r"\s*){0,8})([+-]?)(" + _NUMBER + r")(?!\d)\s*(.*)$"


def parse_quantity(text: Column) -> Column:
    """struct(before, number, rest) of a plain text: the text before the number without hedges, the number, the text after."""
    part = lambda i: F.regexp_extract(text, _FIGURE, i)
    return F.struct(
        F.regexp_replace(part(2), r"\s*" + _HEDGE + r"\s*$", "").alias("before"),
        number_value(F.concat(part(4), part(5))).alias("number"),
        part(6).alias("rest"),
    )


def normalise_units(rows: DataFrame, factors: DataFrame, key: str, value: str, unit: str, note: str, default_unit: str, bound: int = UNITS_BOUND) -> DataFrame:
    """key, number, source, base_value of every row whose value is one quantity.

    The unit is that of the unit field, else that in the value, else the one a remark in the notes states, else the default
    unit; base_value is in the default unit. A scale word in the value multiplies, unless the unit field is the source and
    names the same scaled unit. The names, scaled ones among them, are joined by equality, slot by slot.
    """
    units, names = unit_tables(factors, bound)
    targets = units.select(F.col("unit").alias("_target"), "quantity", F.col("factor").alias("_target_factor"), F.col("offset").alias("_target_offset"))
    base = rows.select(
        F.col(key).alias("_key"), F.col(default_unit).alias("_target"), plain(F.col(value)).alias("v"),
        plain(F.col(unit)).alias("uf"), plain(F.regexp_extract(F.col(note), _NOTE, 1)).alias("nt"),
    ).where(F.col("v").rlike(_FIGURE)).join(targets, "_target")
    given = ("_key", "quantity", "_target_factor", "_target_offset")
    base = base.select(*given, parse_quantity(F.col("v")).alias("q"), "uf", "nt")
    bare = F.regexp_replace(F.regexp_replace(F.trim(F.col("q.rest")), _REMARK, ""), _REMARK, "")
    slots = base.select(
        *given, "q.number",
        unit_key(F.regexp_replace(bare, r"\s*[,;]$", "")).alias("after"), unit_key(F.col("q.before")).alias("ahead"),
        F.coalesce(unit_key(F.col("uf")), F.lit("")).alias("field"), F.coalesce(unit_key(F.col("nt")), F.lit("")).alias("remark"),
    )
    found = slots
    for s in ("after", "ahead", "field", "remark"):
        one = names.select(F.col("quantity").alias("_q"), F.col("key").alias("_k"), F.when(F.col("factor").isNotNull(), F.struct("factor", "offset")).alias(f"{s}_f"), F.col("scale").alias(f"{s}_known"))
        found = found.join(one, (F.col("quantity") == F.col("_q")) & (F.col(s) == F.col("_k")), "left").drop("_q", "_k")
    # scale null: the text names no unit that is known here
    scale = lambda s: F.when(F.col(s) == "", F.lit(1.0)).otherwise(F.col(f"{s}_known")).alias(f"{s}_s")
    own = found.select("number", *given, *[x for s in ("after", "ahead", "field", "remark") for x in (f"{s}_f", scale(s))])
    text_f, text_s = F.coalesce("after_f", "ahead_f"), F.col("after_s") * F.col("ahead_s")
    by_field, in_text, by_note = F.col("field_f").isNotNull(), text_f.isNotNull(), F.col("remark_f").isNotNull()
    same = in_text & (F.col("after_s") == F.col("field_s"))
    default = F.struct(F.col("_target_factor").alias("factor"), F.col("_target_offset").alias("offset"))
    picked = own.select(
        "_key", "number", "_target_factor", "_target_offset",
        F.when(by_field & same, F.col("field_s")).when(by_field, text_s * F.col("field_s")).when(~in_text & by_note, text_s * F.col("remark_s")).otherwise(text_s).alias("scale"),
        F.when(by_field, F.col("field_f")).when(in_text, text_f).when(by_note, F.col("remark_f")).otherwise(default).alias("u"),
        F.when(by_field, "unit field").when(in_text, "value").when(by_note, "notes").otherwise("default").alias("source"),
    )
    # a factor as it is written is a decimal, and so is its product with a scale; only a quotient is rounded, to 15 digits
    shown = lambda c: c.cast("string").try_cast("decimal(24,12)")
    product = shown(F.col("u.factor")) * F.col("scale").cast("decimal(13,0)")
    quotient = F.format_string("%.14e", F.col("u.factor") * F.col("scale") / F.col("_target_factor")).try_cast("decimal(38,12)")
    ratio = F.when(F.col("_target_factor") == 1, product.try_cast("decimal(38,12)")).otherwise(quotient).try_cast("decimal(26,12)")
    shift = ((F.col("u.offset") - F.col("_target_offset")) / F.col("_target_factor")).cast("decimal(24,9)")
    exact = (F.col("number").try_cast("decimal(24,10)") * ratio + shift).try_cast("decimal(38,9)")
    # beyond fourteen digits before the point, by doubles
    rough = (F.col("number").cast("double") * F.col("u.factor") * F.col("scale") + F.col("u.offset") - F.col("_target_offset")) / F.col("_target_factor")
    base_value = F.coalesce(exact, rough.try_cast("decimal(38,9)"))
    # a generator instead of a filter: Catalyst would push a filter, and with it copies of all expressions, below the join
    return picked.select(F.inline(F.when(F.col("scale").isNotNull() & base_value.isNotNull(), F.array(F.struct(F.col("_key").alias(key), "number", "source", base_value.alias("base_value"))))))
