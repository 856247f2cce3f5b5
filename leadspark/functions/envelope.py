"""Message envelopes: base64 around JSON."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _repaired(data: Column) -> Column:
    """Base64 text as lenient decoders see it: URL-safe letters, no padding, stray characters."""
    letters = F.regexp_replace(
        F.translate(F.substring_index(data, "=", 1), "-_", "+/"), "[^A-Za-z0-9+/]", ""
    )
    size = F.length(letters)
    whole = F.when(size % 4 == 1, F.left(letters, size - 1)).otherwise(letters)
    return F.concat(whole, F.repeat(F.lit("="), F.pmod(-F.length(whole), F.lit(4))))


def decoded_text(data: Column) -> Column:
    """Text inside the envelope; bytes that are not UTF-8 become replacement characters."""
    strict = F.try_to_binary(data, F.lit("base64"))
    lenient = F.try_to_binary(_repaired(data), F.lit("base64"))
    return F.make_valid_utf8(F.coalesce(strict, lenient).cast("string"))


def encoded(text: Column) -> Column:
    return F.base64(F.encode(text, "UTF-8"))


def wrapped_event(record: Column) -> Column:
    """The record as an event: JSON, base64, inside {"data":{"message":{"data":...}}}."""
    message = F.struct(encoded(F.to_json(record)).alias("data"))
    return F.to_json(F.struct(F.struct(message.alias("message")).alias("data")))


def event_data(event: Column) -> Column:
    return F.get_json_object(event, "$.data.message.data")


END = "#end-of-record#"


def _listed(text: Column) -> Column:
    """(list, mark): the text as the first of two items of a list, and the second one."""
    # A text may spell the mark, or escape its letters. No text can hold more characters
    # than it has itself, so that such a text gets a mark longer than it is.
    spelled = F.contains(text, F.lit(END)) | F.contains(text, F.lit("\\u"))
    longer = F.repeat(F.lit("#"), F.length(text) + 1)
    mark = F.when(spelled, longer).otherwise(F.lit(END))
    listed = F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]'))
    return F.struct(F.try_parse_json(listed).alias("list"), mark.alias("mark"))


def strict_json(text: Column) -> Column:
    """Parse exactly one JSON value; NULL when anything else stands around it.

    The parser stops after the first value. So the text is read as the first of two items
    of a list, and the second one, our mark, must come out behind it: a text that closes
    the list early loses the mark, and one that brings more items moves it. The
    one-element array parses a text once, whatever becomes of the column.
    """

    def first(held: Column) -> Column:
        marked = F.try_variant_get(held["list"], "$[1]", "string") == held["mark"]
        return F.when(marked, F.try_variant_get(held["list"], "$[0]", "variant"))

    return F.get(F.transform(F.array(_listed(text)), first), F.lit(0))


def rejection(data: Column, value: Column) -> Column:
    """Why an envelope did not decode, NULL when it did."""
    return F.when(
        value.isNull(),
        F.when(
            F.try_to_binary(data, F.lit("base64")).isNull(), F.lit("not_base64")
        ).otherwise(F.lit("not_json")),
    )
