"""SQL fragments shared by the check queries."""

from reviewloom import settings as S
from reviewloom.functions import text as X

MARKUP = (
    r"(?is)<script\b[^>]*>.*?</script>",
    r"(?is)<style\b[^>]*>.*?</style>",
    r"(?s)<!--.*?-->",
    r"<[^>]+>",
    r"(?i)https?://\S+|www\.\S+",
)


def replace_all(x: str, pattern: str, by: str) -> str:
    return f"regexp_replace({x}, '{pattern}', '{by}', 'g')"


def collapse(x: str) -> str:
    return f"trim({replace_all(x, r'[\s\x1c-\x1f]+', ' ')})"


def strip(x: str) -> str:
    return replace_all(x, r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$", "")


def strip_markup(x: str) -> str:
    for pattern in MARKUP:
        x = replace_all(x, pattern, " ")
    return x


def normalise(x: str) -> str:
    return collapse(strip_markup(f"coalesce({x}, '')"))


def classical_clean(x: str) -> str:
    x = replace_all(f"lower({x})", r"[^a-z\s]", " ")
    x = replace_all(x, r"\b[a-z]\b", " ")
    return f"trim({replace_all(x, r'\s+', ' ')})"


def tokens(cleaned: str) -> str:
    for head, tail in S.TOKEN_SPLITS:
        cleaned = replace_all(cleaned, rf"\b{head}{tail}\b", f"{head} {tail}")
    return f"list_filter(regexp_split_to_array({cleaned}, '\\s+'), lambda t: t <> '')"


def word_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def sentiment_filtered(x: str) -> str:
    stops = word_list(X.sentiment_stop_words())
    return (
        f"list_filter({tokens(classical_clean(x))}, "
        f"lambda t: not list_contains({stops}, t) and length(t) > 1)"
    )


def lemmatise(x: str) -> str:
    x = replace_all(x, r"\b([a-z]{2,})ies\b", r"\1y")
    x = replace_all(x, r"\b([a-z]+)(ch|sh|x|z|ss)es\b", r"\1\2")
    x = replace_all(x, r"\b([a-z]*)men\b", r"\1man")
    return replace_all(x, r"\b([a-z]+[a-hj-rtv-z])s\b", r"\1")


def classical_text(x: str) -> str:
    return lemmatise(f"array_to_string({sentiment_filtered(x)}, ' ')")


def labels_table() -> str:
    rows = ", ".join(f"({i}, '{v}')" for i, v in enumerate(S.SENTIMENT_LABELS))
    return f"(values {rows}) as labels_(label_id, label)"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"
