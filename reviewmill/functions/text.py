"""Text expressions. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() and str.split() treat as white space.
SPACE = r"[\t\n\x0B\f\r\x1C-\x1F \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"

# Spam patterns, matched case-insensitively.
SPAM_PATTERNS = (
    r"http[s]?://\S+",
    r"www\.\S+",
    r"click here",
    r"buy\s+now",
    r"free\s+trial",
    r"money\s+back",
    r"\.com",
)

# Sentiment lexicon.
POSITIVE_WORDS = ("excellent", "amazing", "perfect", "love", "great", "awesome", "fantastic", "wonderful")
NEGATIVE_WORDS = ("terrible", "awful", "hate", "worst", "disappointed", "bad", "poor", "horrible")


# The same characters as a plain string, for trimming without a pattern.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def clean_text(text: Column) -> Column:
    """Strip, delete everything outside printable ASCII, collapse spaces; null gives ''.

    Line breaks and tabs are deleted before spaces collapse, so "a\\nb" becomes "ab".
    """
    ascii_only = F.regexp_replace(strip(text), r"[^\x20-\x7E]+", "")
    return F.coalesce(F.regexp_replace(ascii_only, " {2,}", " "), F.lit(""))


def clean_text_basic(text: Column) -> Column:
    """The short variant: delete outside printable ASCII and trim, spaces kept."""
    return F.trim(F.regexp_replace(text, r"[^\x20-\x7E]+", ""))


def tokens(text: Column, cleaned: bool = False) -> Column:
    """White-space tokens without empty ones; null gives an empty array.

    Cleaned text has no white space but the blank, which splits without a pattern.
    """
    parts = F.split(F.coalesce(text, F.lit("")), " " if cleaned else f"{SPACE}+")
    return F.array_remove(parts, "")


def word_count(text: Column, mode: str = "whitespace", cleaned: bool = False) -> Column:
    """Number of words; ``mode="space"`` counts pieces between single spaces ('' has one)."""
    if mode == "space":
        return F.size(F.split(text, " "))
    return F.size(tokens(text, cleaned))


def text_features(text: Column, cleaned: bool = False) -> dict[str, Column]:
    """word_count, char_count and characters per word (spaces count)."""
    words, chars = word_count(text, cleaned=cleaned), F.length(F.coalesce(text, F.lit("")))
    return {
        "word_count": words,
        "char_count": chars,
        "avg_word_length": F.when(words > 0, chars / words).otherwise(F.lit(0.0)),
    }


#: Printable ASCII characters.
PRINTABLE = 95


def is_spam(
    text: Column, min_length: int = 10, min_unique_ratio: float = 0.1, max_upper: float = 0.9
) -> Column:
    """Too short, too few distinct characters, almost all capitals, or a spam phrase.

    The distinct share is taken of the text's length or of the 95 printable
    characters, whichever is less: more than those cannot be distinct, so a long text is not
    spam for its length.
    """
    size = F.length(text)
    distinct = F.size(F.array_distinct(F.split(text, "")))
    upper = F.length(F.regexp_replace(text, "[^A-Z]", ""))
    pattern = "(?i)" + "|".join(SPAM_PATTERNS)
    return (
        (size < min_length)
        | (distinct < F.least(size, F.lit(PRINTABLE)) * F.lit(min_unique_ratio))
        | (upper > size * F.lit(max_upper))
        | text.rlike(pattern)
    )


def text_complexity(text: Column, cleaned: bool = False) -> Column:
    """0.5 distinct share + 0.3 word length (10 = full) + 0.2 word count (100 = full)."""
    words = tokens(text, cleaned)
    total = F.size(words)
    letters = F.length(F.array_join(words, ""))
    score = (
        F.size(F.array_distinct(words)) / total * 0.5
        + F.least(letters / total / 10, F.lit(1.0)) * 0.3
        + F.least(total / F.lit(100), F.lit(1.0)) * 0.2
    )
    return F.when(total > 0, F.least(score, F.lit(1.0))).otherwise(F.lit(0.0))


def sentiment_intensity(text: Column, cleaned: bool = False) -> Column:
    """(positive - negative) / (positive + negative) lexicon hits, 0 without hits."""
    # One walk over the tokens keeps the hits; counting them is then cheap.
    hits = F.filter(tokens(F.lower(text), cleaned), lambda w: w.isin(*POSITIVE_WORDS, *NEGATIVE_WORDS))
    signs = F.transform(hits, lambda w: F.when(w.isin(*POSITIVE_WORDS), 1).otherwise(-1))
    return F.coalesce(F.try_divide(F.aggregate(signs, F.lit(0), lambda a, s: a + s), F.size(hits)), F.lit(0.0))
