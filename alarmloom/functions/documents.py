"""Reading dynamic JSON documents held in VARIANT columns.

Three cases matter to the output tables: a key that is absent, a key that holds JSON null, and a
key with a value. VARIANT keeps them apart; a declared `from_json` struct would merge the first two.
"""

from pyspark.sql import Column, functions as F

JSON_BLANKS = " \t\r\n"


def path(key: str) -> str:
    if '"' in key or "\\" in key:
        raise ValueError(f"key not supported in a document path: {key!r}")
    return f'$["{key}"]'


def object_or_none(text: Column) -> Column:
    """Array with the parsed object, or an empty array if the text is not one whole JSON object.

    Meant for `explode_outer`: the generator evaluates the parser once per row, while a plain
    parsed column would be parsed again in every filter on it.

    The parser stops behind the first value it finds. So the text goes into a list of two, before a
    hash of itself: whatever follows the object breaks the list or keeps the hash from its place.
    """
    ending = F.xxhash64(text)
    pair = F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), ending, F.lit("]")))
    entries = F.array(F.try_variant_get(pair, "$", "array<variant>"))

    def whole(found):
        return (
            _opens_object(text)
            & (F.size(found) == 2)
            & (F.try_variant_get(F.get(found, F.lit(1)), "$", "bigint") == ending)
        )

    return F.transform(F.filter(entries, whole), lambda found: F.get(found, F.lit(0)))


def _opens_object(text: Column) -> Column:
    return F.ltrim(text, F.lit(JSON_BLANKS)).startswith("{")


def unreadable(is_read: Column, text: Column) -> Column:
    """Why there is no object: `trailing_text` behind a good one, else `malformed`; NULL if read.

    Only unread text is parsed a second time.
    """
    goes_on = _opens_object(text) & F.try_parse_json(text).isNotNull()
    return F.when(~is_read & goes_on, F.lit("trailing_text")).when(~is_read, F.lit("malformed"))


def field(doc: Column, key: str) -> Column:
    return F.try_variant_get(doc, path(key), "variant")


def value_text(value: Column) -> Column:
    """A VARIANT value as text: `null` for JSON null, NULL for no value."""
    return F.coalesce(
        F.try_variant_get(value, "$", "string"),
        F.when(F.is_variant_null(value), F.lit("null")),
    )


def field_text(doc: Column, key: str) -> Column:
    return F.coalesce(
        F.try_variant_get(doc, path(key), "string"),
        F.when(F.is_variant_null(field(doc, key)), F.lit("null")),
    )


def members(doc: Column, keys: list[str], lists: list[str] = ()) -> Column:
    """The listed keys as a struct of VARIANT values, found in one walk through the object.

    `lists` are taken as arrays of VARIANT, NULL where the key holds something else.
    """
    fields = [f"`{key}`: variant" for key in keys] + [f"`{key}`: array<variant>" for key in lists]
    return F.try_variant_get(doc, "$", f"struct<{', '.join(fields)}>")


def integer_code(doc: Column, key: str) -> Column:
    """The value if it is a JSON integer, else NULL: `"6"` and `6.0` are not the code 6."""
    value = field(doc, key)
    return F.when(
        F.schema_of_variant(value) == "BIGINT", F.try_variant_get(value, "$", "int")
    )


def has_value(doc: Column, key: str) -> Column:
    """The key is there and does not hold JSON null."""
    return F.try_variant_get(doc, path(key), "string").isNotNull()


def object_list(doc: Column, key: str) -> Column:
    return F.try_variant_get(doc, path(key), "array<variant>")


def text_map(doc: Column) -> Column:
    """All keys of the object with their values as text (`null` for JSON null)."""
    entries = F.try_variant_get(doc, "$", "map<string,variant>")
    return F.transform_values(
        entries, lambda _, v: F.coalesce(F.try_variant_get(v, "$", "string"), F.lit("null"))
    )
