"""Column expressions for review text.

Everything stays in JVM expressions except two steps Spark has no function for:
HTML entity decoding and Unicode NFKC.  Those run as plain Python UDFs, which hold a
hundred texts at a time (an Arrow batch holds thousands, several times over), and only
rows that need them carry text to Python.
"""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from reviewloom import settings as S

# White space as Python's str.split and str.strip see it.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]+"
NOT_SPACE = r"[^\s\x1c-\x1f\x85\p{Z}]"
# Letters, digits and underscore, two or more: a word token.
WORD = r"[\p{L}\p{N}_]{2,}"


@F.udf(StringType(), useArrow=False)
def _decode_entities(value: str | None) -> str | None:
    return None if value is None else html.unescape(value)


def _compose(value: str) -> str:
    folded = unicodedata.normalize("NFKC", value)
    if "".join(folded.split()).isprintable():
        return folded
    return "".join(c for c in folded if c.isprintable() or c.isspace())


@F.udf(StringType(), useArrow=False)
def _fold_unicode(value: str | None) -> str | None:
    return None if value is None else _compose(value)


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip_markup(text: Column) -> Column:
    """Script and style blocks, comments, tags and URLs become spaces.

    Each group of patterns only runs on texts that hold its first characters.
    """
    return bind(bind(text, _without_tags), _without_urls)


def _without_tags(text: Column) -> Column:
    bare = text
    for pattern in (
        r"(?is)<script\b[^>]*>.*?</script>",
        r"(?is)<style\b[^>]*>.*?</style>",
        r"(?s)<!--.*?-->",
        r"<[^>]+>",
    ):
        bare = F.regexp_replace(bare, pattern, " ")
    return F.when(F.contains(text, F.lit("<")), bare).otherwise(text)


def _without_urls(text: Column) -> Column:
    has_url = F.contains(text, F.lit("://")) | F.rlike(text, F.lit(r"[wW]{3}\."))
    url = r"(?i)https?://[^\s\x1c-\x1f\x85\p{Z}]+|www\.[^\s\x1c-\x1f\x85\p{Z}]+"
    return F.when(has_url, F.regexp_replace(text, url, " ")).otherwise(text)


def collapse_spaces(text: Column) -> Column:
    """Any run of Unicode white space becomes one space; ends are trimmed."""
    plain = F.regexp_replace(text, r"[\x09-\x0d\x1c-\x1f\x85\p{Z}&&[^ ]]", " ")
    return F.trim(F.regexp_replace(plain, " {2,}", " "))


def normalise_text(text: Column) -> Column:
    """Minimal normaliser: keeps case, punctuation and word order."""
    raw = F.coalesce(text.cast("string"), F.lit(""))
    # Entities first: decoded tags must then be stripped.
    decoded = F.coalesce(
        _decode_entities(F.when(F.contains(raw, F.lit("&")), raw)), raw
    )
    bare = strip_markup(decoded)
    # ASCII text is already NFKC; only its control characters go.
    foreign = bind(bare, lambda b: F.when(F.rlike(b, F.lit(r"[^\x00-\x7F]")), b))
    folded = F.coalesce(
        _fold_unicode(foreign),
        F.regexp_replace(bare, r"[\x00-\x08\x0e-\x1b\x7f]", ""),
    )
    return collapse_spaces(folded)


def classical_clean(text: Column) -> Column:
    """Lowercase a-z words of two letters or more, single spaces."""
    return F.array_join(F.regexp_extract_all(F.lower(text), F.lit("[a-z]{2,}"), F.lit(0)), " ")


def tokens(cleaned: Column, splits=S.TOKEN_SPLITS) -> Column:
    """Whitespace tokens after the word tokeniser's contraction splits."""
    heads = "|".join(rf"{head}(?={tail}\b)" for head, tail in splits)
    parted = F.regexp_replace(cleaned, rf"\b({heads})", "$1 ")
    return F.filter(F.split(parted, " "), lambda t: t != "")


def sentiment_stop_words() -> list[str]:
    """English stop words without the negations that carry sentiment."""
    return [w for w in S.ENGLISH_STOP_WORDS if w not in S.NEGATION_WORDS]


def topic_stop_words(
    extra: Iterable[str] = (), english: Iterable[str] = S.ENGLISH_STOP_WORDS
) -> list[str]:
    """English, domain and extra words, lowercased, distinct and sorted."""
    words = {*english, *S.DOMAIN_STOP_WORDS, *extra}
    return sorted({w.strip().lower() for w in words} - {""})


def drop_words(tokens_: Column, stop_words: Iterable[str], min_length: int = 1) -> Column:
    """Tokens that are not stop words; the list becomes one hash set in the plan."""
    stops = list(stop_words)
    return F.filter(tokens_, lambda t: ~t.isin(stops) & (F.length(t) >= min_length))


def lemmatise(words: Column, rules=S.NOUN_SUFFIX_RULES) -> Column:
    """Noun suffix rules over a space-joined text, one regular expression each."""
    for ending, replacement in rules:
        words = F.regexp_replace(words, ending, replacement)
    return words


def classical_text(text: Column, stop_words: Iterable[str] | None = None) -> Column:
    """Clean, tokenise, drop stop words, lemmatise; one space-joined string."""
    stops = sentiment_stop_words() if stop_words is None else stop_words
    kept = drop_words(tokens(classical_clean(text)), stops, min_length=2)
    return lemmatise(F.array_join(kept, " "))


def word_tokens(text: Column) -> Column:
    """Lowercase word tokens of two or more characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def with_bigrams(words: Column) -> Column:
    """The words followed by all pairs of neighbours joined with a space."""
    return bind(words, _and_pairs)


def _and_pairs(words: Column) -> Column:
    pairs = F.when(
        F.size(words) > 1,
        F.zip_with(
            F.slice(words, F.lit(1), F.size(words) - 1),
            F.slice(words, F.lit(2), F.size(words) - 1),
            # Words are never NULL, and concat is the cheaper of the two where rows are long.
            lambda a, b: F.concat(a, F.lit(" "), b),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.concat(words, pairs)


def split_words(text: Column) -> Column:
    """Tokens between runs of white space."""
    return F.filter(F.split(text, SPACE), lambda t: t != "")


def word_count(text: Column) -> Column:
    """Number of whitespace-separated tokens."""
    return F.size(split_words(text))


def strip(text: Column) -> Column:
    """Text without white space at either end."""
    return F.regexp_replace(text, f"^{SPACE}|{SPACE}$", "")
