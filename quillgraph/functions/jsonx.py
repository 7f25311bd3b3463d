"""JSON in model answers: parsed to VARIANT, or null; never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(c: Column) -> Column:
    """VARIANT, null for text that is no JSON and for JSON null. Repeated keys and NaN are refused, unlike in Python."""
    v = F.try_parse_json(c)
    return F.when(~F.is_variant_null(v), v)


def block(c: Column) -> Column:
    """From the first { to the } that closes it; braces in strings count too; null if there is none or it never closes.

    The prefix sums of braces are folded over the braces only, so the cost is linear in the text.
    """
    start = F.instr(c, "{")
    rest = F.substring(c, start, F.length(c))
    # pieces between braces: the piece after the i-th brace begins at the sum of lengths so far
    pieces = F.split(rest, r"(?=[{}])")
    step = lambda s, p: F.when(s["at"].isNotNull(), s).otherwise(
        F.when(p.startswith("{"), F.struct((s["depth"] + 1).alias("depth"), (s["length"] + F.length(p)).alias("length"), s["at"].alias("at")))
        .when(p.startswith("}") & (s["depth"] == 1), F.struct((s["depth"] - 1).alias("depth"), s["length"].alias("length"), (s["length"] + 1).alias("at")))
        .when(p.startswith("}"), F.struct((s["depth"] - 1).alias("depth"), (s["length"] + F.length(p)).alias("length"), s["at"].alias("at")))
        .otherwise(F.struct(s["depth"].alias("depth"), (s["length"] + F.length(p)).alias("length"), s["at"].alias("at")))
    )
    none = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("length"), F.lit(None).cast("int").alias("at"))
    end = F.aggregate(pieces, none, step)["at"]
    return F.when(start > 0, F.substring(rest, F.lit(1), end))


def robust(c: Column) -> Column:
    """The whole text as JSON, else its first block."""
    return F.coalesce(parsed(c), parsed(block(c)))
