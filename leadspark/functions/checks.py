"""Rules a record must meet at the border of a stage.

A record comes as a VARIANT, so a missing field, a null and a value of the wrong type stay
apart. Rules look at columns that are made once per record: `shape`, the type of the whole
record; `values`, the fields cast to what they should be; and, where these do not settle
it, `kinds`, the type of each field. Each rule gives NULL or a short code, "field:reason".
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

URI_PATTERN = (
    r"^[A-Za-z][A-Za-z0-9+.-]*:(?://)?"
    r"(?:[A-Za-z0-9._~:/?#\[\]@!$&'()*+,;=-]|%[0-9A-Fa-f]{2})+$"
)


@dataclass(frozen=True)
class Field:
    """A required field. `type` casts its value, `kind` is its usual type in JSON."""

    name: str
    type: str = ""
    kind: str = ""

    def found(self) -> Column:
        return F.col("kinds")[self.name]

    def value(self) -> Column:
        return F.col(f"values.{self.name}")

    def code(self, reason: str) -> Column:
        return F.lit(f"{self.name}:{reason}")

    def fits(self) -> Column:
        """Whether a value of the usual type will do."""
        raise NotImplementedError

    def rule(self) -> Column:
        """The code of what is wrong with the field, NULL when nothing is."""
        raise NotImplementedError


class Text(Field):
    """A text that is not empty."""

    def fits(self) -> Column:
        return self.value() != ""

    def rule(self) -> Column:
        return (
            F.when(self.found().isNull(), self.code("required"))
            .when(self.found() != "STRING", self.code("string"))
            .when(self.value() == "", self.code("empty"))
        )


class Uri(Text):
    """An absolute URI."""

    def fits(self) -> Column:
        return self.value().rlike(URI_PATTERN)

    def rule(self) -> Column:
        return super().rule().when(~self.value().rlike(URI_PATTERN), self.code("uri"))


class Texts(Field):
    """A list, which may be empty, of texts that are not."""

    def fits(self) -> Column:
        return ~F.exists(self.value(), lambda item: item.isNull() | (item == ""))

    def rule(self) -> Column:
        only_texts = self.found().isin("ARRAY<STRING>", "ARRAY<VOID>")
        return (
            F.when(self.found().isNull(), self.code("required"))
            .when(~self.found().startswith("ARRAY"), self.code("array"))
            .when(~only_texts | ~self.fits(), self.code("items"))
        )


@dataclass(frozen=True)
class WholeNumber(Field):
    """A whole number in a range; text that holds one counts."""

    low: int = 0
    high: int = 0

    def fits(self) -> Column:
        return self.value().between(self.low, self.high)

    def rule(self) -> Column:
        numeric = self.found().rlike("^(STRING|BIGINT|DECIMAL|DOUBLE|FLOAT)")
        return (
            F.when(self.found().isNull(), self.code("required"))
            .when(~numeric | self.value().isNull(), self.code("number"))
            .when(self.value() != F.floor(self.value()), self.code("integer"))
            .when(self.value() < self.low, self.code("min"))
            .when(self.value() > self.high, self.code("max"))
        )


class Object(Field):
    """An object with any contents."""

    def rule(self) -> Column:
        return F.when(self.found().isNull(), self.code("required")).when(
            ~self.found().startswith("OBJECT"), self.code("object")
        )


class Truthy(Field):
    """A value that is neither missing, null, empty, zero nor false."""

    def rule(self) -> Column:
        number = self.found().rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
        missing = (
            self.found().isNull()
            | (self.found() == "VOID")
            | ((self.found() == "STRING") & (self.value() == ""))
            | ((self.found() == "BOOLEAN") & (self.value() == "false"))
            | (number & (self.value().try_cast("double") == 0))
        )
        return F.when(missing, self.code("required"))


@dataclass(frozen=True)
class RecordType:
    """The fields of a record in order, and whether others may stand beside them."""

    fields: tuple[Field, ...]
    others: bool = False

    def usual(self) -> str | None:
        """The shape that records of this type nearly always have, if there is one."""
        kinds = {field.name: field.kind for field in self.fields}
        if self.others or not all(kinds.values()):
            return None
        return "OBJECT<" + ", ".join(f"{name}: {kinds[name]}" for name in sorted(kinds)) + ">"

    def kinds(self) -> Column:
        """Types by field."""
        return F.transform_values(
            F.try_variant_get("record", "$", "map<string,variant>"),
            lambda name, value: F.schema_of_variant(value),
        )

    def values(self) -> Column:
        typed = [f"{field.name}:{field.type}" for field in self.fields if field.type]
        return F.try_variant_get("record", "$", f"struct<{','.join(typed)}>")

    def errors(self) -> Column:
        """All codes in order. What is no object at all has this one error."""
        codes = [field.rule() for field in self.fields]
        if not self.others:
            known = F.array(*[F.lit(field.name) for field in self.fields])
            unknown = F.array_min(F.array_except(F.map_keys("kinds"), known))
            codes.append(F.concat(unknown, F.lit(":unknown")))
        listed = F.when(
            F.col("shape").startswith("OBJECT"), F.array_compact(F.array(*codes))
        ).otherwise(F.array(F.lit("record:object")))
        return F.when(F.col("good"), F.array().cast("array<string>")).otherwise(listed)

    def good(self) -> Column:
        """A short way to find that nothing is wrong; other good records pass the rules."""
        if self.usual() is None:
            return F.lit(False)
        fits = [F.col("shape") == self.usual()] + [field.fits() for field in self.fields]
        return F.coalesce(reduce(lambda a, b: a & b, fits), F.lit(False))


def _text(name: str) -> Field:
    return Text(name, "string", "STRING")


def _uri(name: str) -> Field:
    return Uri(name, "string", "STRING")


ARTICLE = RecordType((_text("clean_text"), _uri("source_url"), _text("source_domain")))

ANALYSIS = RecordType(
    (
        _text("companyName"),
        _text("industry"),
        _text("region"),
        _text("opportunityType"),
        _text("summary"),
        Texts("potentialNeed", "array<string>", "ARRAY<STRING>"),
        WholeNumber("opportunityScore", "decimal(38,10)", "BIGINT", low=1, high=10),
        _text("keyQuote"),
        _uri("sourceURL"),
    )
)

ENRICHED = RecordType(ANALYSIS.fields + (Object("verification"), Object("internal_qc")))

CORRECTION = RecordType((Truthy("id", "string"),), others=True)
