"""Text of articles: hosts, page clean-up, keywords, prompts."""

from html.entities import name2codepoint
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadspark.config import ARTICLE_MARKER, PROMPT_TEMPLATE

HOST_PATTERN = (
    r"^[a-z][a-z0-9+.-]*://(?:[^/?#\\]*@)?"
    r"([^/?#:@\\\s<>^|%\[\]]+|\[[0-9a-f:.]+\])(?::[0-9]*)?(?:[/?#\\]|$)"
)

# Parts of a page that are not the article.
NOISE_PATTERN = (
    r"(?is)<(?:!--.*?-->|script\b.*?</script\s*>|style\b.*?</style\s*>"
    r"|nav\b.*?</nav\s*>|footer\b.*?</footer\s*>|aside\b.*?</aside\s*>"
    r'|div class="ad"[^>]*>.*?</div\s*>)'
)
ARTICLE_PATTERN = r"(?is)^.*?<article\b[^>]*>(.*)</article\s*>.*$"
INLINE_TAG_PATTERN = r"(?i)</?(?:a|abbr|b|em|i|mark|small|span|strong|sub|sup|u)\b[^>]*>"
TAG_PATTERN = r"<[^>]*>"
# Leaves single blanks as they are.
BLANKS_PATTERN = r"\s{2,}|[^\S ]"

# Named characters: those of HTML 4, and two that differ. A blank that does not break lines
# is a blank like any other here.
NAMED = {**{name: chr(point) for name, point in name2codepoint.items()}, "apos": "'", "nbsp": " "}


def url_host(url: Column) -> Column:
    """Host of an absolute URL in lower case, without user and port; NULL without one."""
    return F.nullif(
        F.regexp_extract(F.lower(F.trim(url)), HOST_PATTERN, 1), F.lit("")
    )


def _code_point(number: Column) -> Column:
    """Character of a code point, NULL outside the range of characters."""
    known = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    four_bytes = F.unhex(F.lpad(F.hex(number), 8, "0"))
    return F.when(known, F.decode(four_bytes, "UTF-32"))


def _decoded(text: Column) -> Column:
    """The pieces after each "&" begin with a name or number, or stay as they are."""
    names = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])

    def piece(part: Column, index: Column) -> Column:
        digits = F.regexp_extract(part, "^#0*+([0-9]{1,7}+);", 1)
        hex_digits = F.regexp_extract(part, "^#[xX]0*+([0-9A-Fa-f]{1,6}+);", 1)
        number = F.when(digits != "", digits.cast("bigint")).when(
            hex_digits != "", F.conv(hex_digits, 16, 10).cast("bigint")
        )
        name = F.regexp_extract(part, "^([A-Za-z][A-Za-z0-9]*+);", 1)
        # Most pieces begin with the one name that every page has.
        character = F.when(name == "amp", "&").when(name != "", F.try_element_at(names, name))
        rest = F.substring(part, F.locate(";", part) + 1, F.length(part))
        return F.when(index == 0, part).otherwise(
            F.coalesce(
                F.concat(F.coalesce(character, _code_point(number)), rest),
                F.concat(F.lit("&"), part),
            )
        )

    decoded = F.array_join(F.transform(F.split(text, "&"), piece), "")
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def decode_entities(text: Column) -> Column:
    """Named and numbered characters of HTML undone, once."""
    # The one-element array computes a text once, however often it is looked at.
    return F.get(F.transform(F.array(text), _decoded), F.lit(0))


def clean_text(html: Column) -> Column:
    """Body of an article: no scripts, navigation, ads or tags, blanks squashed.

    A page without an article element is kept whole.
    """
    body = F.regexp_replace(html, NOISE_PATTERN, " ")
    article = F.regexp_replace(body, ARTICLE_PATTERN, "$1")
    text = F.regexp_replace(article, INLINE_TAG_PATTERN, "")
    text = F.regexp_replace(text, TAG_PATTERN, " ")
    return F.trim(F.regexp_replace(decode_entities(text), BLANKS_PATTERN, " "))


def has_keyword(text: Column, keywords: tuple[str, ...]) -> Column:
    """True when any keyword is part of the lower-cased text; the keywords keep their case."""
    # Short keywords hit most often. The one-element array lower-cases a text once.
    ordered = F.lit(sorted(keywords, key=len)).cast("array<string>")
    return F.exists(
        F.array(F.lower(text)),
        lambda low: F.exists(ordered, lambda keyword: F.contains(low, keyword)),
    )


def filled(template: str, **values: Column) -> Column:
    """A text with columns in place of its {names}."""
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        parts.append(F.lit(literal))
        if name is not None:
            parts.append(values[name])
    return F.concat(*parts)


def render_prompt(text: Column, template: str = PROMPT_TEMPLATE) -> Column:
    """The template with the article in place of its first marker."""
    head, marker, tail = template.partition(ARTICLE_MARKER)
    if not marker:
        return F.lit(template)
    return F.concat(F.lit(head), text, F.lit(tail))
