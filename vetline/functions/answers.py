"""Parse untrusted JSON answers (model output) into typed evaluation fields.

Semantics follow Python's ``json.loads`` + ``dict.get`` + truthiness:

* the whole text must be one JSON value (trailing text is a parse error);
* not JSON at all -> ``parse_error`` stub (not a vacancy, score 0,
  reasoning ``parse_error``);
* JSON but not an object, a list field that is a non-zero number/boolean, or
  an infinite score -> ``crash`` (no result);
* ``bool(x)``: ``"false"`` is true; 0, "", null, [] and {} are false;
* ``str(x or default)`` for text fields, ``reasoning`` stripped;
* list fields: NULL/falsy -> [], falsy elements dropped, rest stringified;
  a string iterates to its characters, an object to its (sorted) keys;
* score: ``int(x)`` then bound to 0..100; strings must be integer literals.

Everything is a Catalyst expression over ``VARIANT`` (``try_parse_json``),
so parsing runs inside whole-stage codegen with no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.functions.text import PY_WHITESPACE

# ---- fixed values -----------------------------------------------------------
# Defaults of the evaluation fields when the answer omits them.
TEXT_DEFAULTS = {"title": "", "company": "", "grade": "unknown", "salary": "", "remote": "unknown"}
PARSE_ERROR_REASONING = "parse_error"
# The raw text is wrapped as  [<raw>\n,"\u0001end"]  so that the parse must
# consume the whole raw text: text after the first JSON value breaks the array.
_SENTINEL_JSON = '"\\u0001end"'
_SENTINEL_VALUE = "\u0001end"
# -----------------------------------------------------------------------------

# The kind of a VARIANT, told by its JSON text ``j`` (NULL: the key is absent):
# n null, t true, f false, s string, a array, o object, # number.  A number that is
# not finite is written as a string, so only such a text asks for the stored type.
_NOT_FINITE = """('"Infinity"', '"-Infinity"', '"NaN"')"""


def _kind_sql(v: str, j: str) -> str:
    return (f"(CASE substring({j}, 1, 1) WHEN 'n' THEN 'n' WHEN 't' THEN 't' WHEN 'f' THEN 'f' WHEN '[' THEN 'a' WHEN '{{' THEN 'o' "
            f"WHEN '\"' THEN IF({j} IN {_NOT_FINITE} AND schema_of_variant({v}) <> 'STRING', '#', 's') WHEN '' THEN 'n' ELSE IF({j} IS NULL, 'n', '#') END)")


def _truthy_sql(v: str, j: str, k: str) -> str:
    """Python truthiness of a VARIANT ``v`` of kind ``k``."""
    return (f"(CASE {k} WHEN 't' THEN true WHEN 's' THEN {j} <> '\"\"' WHEN '#' THEN try_variant_get({v}, '$', 'double') <> 0 "
            f"WHEN 'a' THEN {j} <> '[]' WHEN 'o' THEN {j} <> '{{}}' ELSE false END)")


def _pystr_sql(v: str, j: str, k: str) -> str:
    """``str(x)`` of a VARIANT: strings as is, booleans True/False, numbers
    as numbers, containers as JSON text."""
    return (f"(CASE {k} WHEN 't' THEN 'True' WHEN 'f' THEN 'False' WHEN 'a' THEN {j} WHEN 'o' THEN {j} "
            f"ELSE try_variant_get({v}, '$', 'string') END)")


def _told_sql(values: str) -> str:
    """An array of VARIANTs as structs: value, JSON text, kind."""
    return (f"transform(transform({values}, x -> named_struct('v', x, 'j', to_json(x))), "
            f"e -> named_struct('v', e.v, 'j', e.j, 'k', {_kind_sql('e.v', 'e.j')}))")


def _list_sql(v: str, k: str, truthy: str) -> str:
    """``[str(x) for x in (v or []) if x]`` for a field of kind ``k`` and
    truthiness column ``truthy``."""
    values = f"variant_get({v}, '$', 'array<variant>')"
    return (f"(CASE WHEN NOT {truthy} THEN CAST(array() AS array<string>) "
            f"WHEN {k} = 'a' THEN transform(filter({_told_sql(values)}, e -> {_truthy_sql('e.v', 'e.j', 'e.k')}), e -> {_pystr_sql('e.v', 'e.j', 'e.k')}) "
            f"WHEN {k} = 's' THEN filter(split(variant_get({v}, '$', 'string'), ''), c -> c <> '') "
            f"WHEN {k} = 'o' THEN filter(map_keys(variant_get({v}, '$', 'map<string,variant>')), k -> k <> '') "
            f"END)")


def _list_crashes_sql(k: str, truthy: str) -> str:
    """A truthy list field that is not iterable (number, boolean) raises."""
    return f"({truthy} AND {k} IN ('t', '#'))"


def _score_sql(v: str, k: str) -> str:
    """``max(0, min(100, int(x)))``; bad values give 0 (NULL: raises)."""
    num = f"try_variant_get({v}, '$', 'double')"
    return (f"(CASE {k} WHEN 't' THEN 1 WHEN '#' THEN IF(isnan({num}) OR abs({num}) = double('inf'), NULL, "
            f"CAST(greatest(0D, least(100D, {num})) AS INT)) "
            f"WHEN 's' THEN CAST(greatest(0L, least(100L, "
            f"coalesce(try_cast(variant_get({v}, '$', 'string') AS BIGINT), 0L))) AS INT) "
            f"ELSE 0 END)")


FIELDS = ("is_vacancy", "title", "company", "stack", "grade", "salary", "remote",
          "match_score", "reasoning", "red_flags", "should_apply")


def parse_answers(df: DataFrame, raw_col: str = "raw") -> DataFrame:
    """Add ``parse_status`` (ok | parse_error | crash) and the typed fields.

    A NULL raw answer (no content) is read as ``{}``.  ``crash`` rows carry
    NULL fields; ``parse_error`` rows carry the stub values.  The per-field
    conversions run as one ``transform`` over the array of field values (the
    conversion is written once, not once per field), which keeps the
    generated code of the stage small.
    """
    idx = {f: i for i, f in enumerate(FIELDS)}
    wrapped = F.concat(F.lit("["), F.coalesce(F.col(raw_col), F.lit("{}")), F.lit("\n," + _SENTINEL_JSON + "]"))
    p = df.withColumn("_v", F.try_parse_json(wrapped))
    p = p.select("*",
                 F.coalesce(F.expr(f"try_variant_get(_v, '$[1]', 'string') = '{_SENTINEL_VALUE}' "
                                   "AND try_variant_get(_v, '$[2]', 'variant') IS NULL"),
                            F.lit(False)).alias("_wrap_ok"),
                 F.expr("try_variant_get(_v, '$[0]', 'variant')").alias("_d")).drop("_v")
    fields = ", ".join(f"try_variant_get(_d, '$.{f}', 'variant')" for f in FIELDS)
    told = _told_sql(f"array({fields})")
    p = p.select("*", F.expr("try_variant_get(_d, '$', 'struct<>') IS NOT NULL").alias("_is_obj"), F.expr(
        f"transform({told}, e -> named_struct('v', e.v, 't', e.k, 'b', {_truthy_sql('e.v', 'e.j', 'e.k')}, "
        f"'s', {_pystr_sql('e.v', 'e.j', 'e.k')}))").alias("_g")).drop("_d")

    def g(f: str, part: str) -> str:
        return f"_g[{idx[f]}].{part}"

    p = p.withColumn("_score", F.expr(_score_sql(g("match_score", "v"), g("match_score", "t"))))
    crash = (~F.col("_is_obj")
             | F.expr(_list_crashes_sql(g("stack", "t"), g("stack", "b")))
             | F.expr(_list_crashes_sql(g("red_flags", "t"), g("red_flags", "b")))
             | F.col("_score").isNull())
    p = p.withColumn("parse_status", F.when(~F.col("_wrap_ok"), F.lit("parse_error"))
                     .when(crash, F.lit("crash")).otherwise(F.lit("ok")))

    ok = F.col("parse_status") == "ok"
    perr = F.col("parse_status") == "parse_error"

    def pick(ok_val: Column, stub_val: Column) -> Column:
        return F.when(ok, ok_val).when(perr, stub_val)

    def text_value(f: str, default: str) -> Column:
        return F.when(F.expr(g(f, "b")), F.expr(g(f, "s"))).otherwise(F.lit(default))

    def text_field(f: str) -> Column:
        return pick(text_value(f, TEXT_DEFAULTS[f]), F.lit(TEXT_DEFAULTS[f]))

    def list_field(f: str) -> Column:
        return pick(F.expr(_list_sql(g(f, "v"), g(f, "t"), g(f, "b"))), F.array().cast("array<string>"))

    reasoning = F.btrim(text_value("reasoning", ""), F.lit(PY_WHITESPACE))
    out_cols = {
        "is_vacancy": pick(F.expr(g("is_vacancy", "b")), F.lit(False)),
        "title": text_field("title"),
        "company": text_field("company"),
        "stack": list_field("stack"),
        "grade": text_field("grade"),
        "salary": text_field("salary"),
        "remote": text_field("remote"),
        "match_score": pick(F.col("_score"), F.lit(0)),
        "reasoning": pick(reasoning, F.lit(PARSE_ERROR_REASONING)),
        "red_flags": list_field("red_flags"),
        "should_apply": pick(F.expr(g("should_apply", "b")), F.lit(False)),
    }
    keep = [c for c in df.columns if c not in out_cols]
    # Emit the results through a one-row generator: a later filter on these
    # columns then stays above it instead of being pushed below the staged
    # projections (which would inline and repeat the whole parse).
    result = F.struct(F.col("parse_status"), *[v.alias(k) for k, v in out_cols.items()])
    return p.select(*keep, F.inline(F.array(result)))
