"""List- and dict-shaped text, as Python prints it, into arrays and maps."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from rankdex.functions.text import once, replace_first

# Fixed values: \xNN after an even number of backslashes, and a comma before the last bracket.
_HEX_ESCAPE = r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})"
_TRAILING_COMMA = r",\s*([\]}])\s*$"


def _json_text(literal: Column) -> Column:
    """``literal`` in the form that Spark's JSON parser takes."""
    # Few texts hold such an escape: spare the others the pattern.
    unicode_escapes = F.when(
        literal.contains("\\x"), F.regexp_replace(literal, _HEX_ESCAPE, r"$1\\u00$2")
    ).otherwise(literal)
    return F.regexp_replace(unicode_escapes, _TRAILING_COMMA, "$1")


def _parsed(json: Column, kind: str, parts: str) -> Column:
    """``json`` as a value of type ``kind``, or NULL if that is not the whole text or a
    part of it is a list or dict of its own.

    The parser stops after a first value, so the text is put into an object with a
    mark behind it, its hash, which only a whole value leaves in place. Read as ``parts``, the
    same type with variants, it shows what each part is.
    """
    options = {"allowSingleQuotes": "true", "allowUnquotedFieldNames": "true"}

    def checked(json: Column) -> Column:
        mark = F.xxhash64(json)
        marked = F.concat(F.lit('{"v": '), json, F.lit(', "end": '), mark.cast("string"), F.lit("}"))

        def parse(of: str) -> Column:
            return F.from_json(marked, f"struct<v: {of}, end: long>", options)

        values = F.map_values(parse(parts)["v"]) if parts.startswith("map") else parse(parts)["v"]
        inner = F.exists(values, lambda part: F.schema_of_variant(part).rlike("^(ARRAY|OBJECT)"))
        # Few texts hold a second bracket: spare the others the parsing of parts.
        suspicious = json.rlike(r"(?s)^\s*.[^\[{]*[\[{]")
        plain = ~F.when(suspicious, F.coalesce(inner, F.lit(False))).otherwise(F.lit(False))
        return once(parse(kind), lambda whole: F.when((whole["end"] == mark) & plain, whole["v"]))

    return once(json, checked)


def list_literal(literal: Column) -> Column:
    """``['a', "b's"]`` to an array of strings; NULL when it does not parse as a whole,
    or holds lists or dicts."""
    return _parsed(_json_text(literal), "array<string>", "array<variant>")


def with_map(df: DataFrame, column: str) -> DataFrame:
    """``{865: 'title', …}`` in ``column`` to a map of ids to titles, ids ascending.

    The last title of a repeated id wins. NULL when the text does not parse as a whole,
    a title is a list or dict, or a key is no integer. Everything happens inside the row: no shuffle.
    """
    parsed = _parsed(_json_text(F.col(column)), "map<string,string>", "map<string,variant>")
    entries = F.transform(
        F.map_entries(parsed),
        lambda entry, at: F.struct(
            entry["key"].try_cast("long").alias("id"),
            at.alias("at"),
            entry["value"].alias("title"),
        ),
    )

    def by_id(entries: Column) -> Column:
        last_of_id = F.filter(
            entries,
            lambda entry, at: F.coalesce(F.get(entries, at + 1)["id"] != entry["id"], F.lit(True)),
        )
        pairs = F.transform(last_of_id, lambda entry: F.struct(entry["id"], entry["title"]))
        bad_key = F.exists(entries, lambda entry: entry["id"].isNull())
        return F.when(~bad_key, F.map_from_entries(pairs))

    return df.withColumn(column, once(F.sort_array(entries), by_id))


def normalise(
    df: DataFrame,
    lists: Iterable[str] = (),
    maps: Iterable[str] = (),
    hosts: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Parse the text columns named in ``lists`` and ``maps`` in place, and replace
    the first host of the columns in ``hosts`` (``{"url": ("www.x", "embed.x")}``).

    Each parsed column gets a ``<name>_parse_error`` flag: text that is not NULL
    and did not parse.
    """
    for name in (*lists, *maps):
        df = df.withColumn(f"_raw_{name}", F.col(name))
    for name in lists:
        df = df.withColumn(name, list_literal(F.col(name)))
    for name in maps:
        df = with_map(df, name)
    for name in (*lists, *maps):
        failed = F.col(f"_raw_{name}").isNotNull() & F.col(name).isNull()
        df = df.withColumn(f"{name}_parse_error", failed).drop(f"_raw_{name}")
    for name, (old, new) in (hosts or {}).items():
        df = df.withColumn(name, replace_first(F.col(name), old, new))
    return df


def related_entries(df: DataFrame, key: str, related: str) -> DataFrame:
    """One row per entry of the map ``related``: the document, the entry's place in
    ascending id order, its id and its title."""
    return df.select(
        key, F.posexplode(F.sort_array(F.map_entries(related))).alias("place", "_entry")
    ).select(
        key,
        "place",
        F.col("_entry.key").alias("related_id"),
        F.col("_entry.value").alias("related_title"),
    )
