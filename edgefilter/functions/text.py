"""Text expressions: word extraction, whitespace tokens, stop words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The English stop-word list of the NLTK corpus, in its own
# order. Word extraction removes exactly these.
ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're",
    "you've", "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he",
    "him", "his", "himself", "she", "she's", "her", "hers", "herself", "it", "it's",
    "its", "itself", "they", "them", "their", "theirs", "themselves", "what",
    "which", "who", "whom", "this", "that", "that'll", "these", "those", "am", "is",
    "are", "was", "were", "be", "been", "being", "have", "has", "had", "having",
    "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or",
    "because", "as", "until", "while", "of", "at", "by", "for", "with", "about",
    "against", "between", "into", "through", "during", "before", "after", "above",
    "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why",
    "how", "all", "any", "both", "each", "few", "more", "most", "other", "some",
    "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too", "very",
    "s", "t", "can", "will", "just", "don", "don't", "should", "should've", "now",
    "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn",
    "couldn't", "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn",
    "hasn't", "haven", "haven't", "isn", "isn't", "ma", "mightn", "mightn't",
    "mustn", "mustn't", "needn", "needn't", "shan", "shan't", "shouldn",
    "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn",
    "wouldn't",
)

# Unicode word characters (Java's \w is ASCII-only and would split "über").
WORD_PATTERN = r"[\p{L}\p{N}_]+"


def stop_words(language: str = "english") -> list[str]:
    if language != "english":
        raise ValueError(f"no stop-word list for {language!r}")
    return list(ENGLISH_STOP_WORDS)


def raw_words(c: Column) -> Column:
    """Lower-cased Unicode words, stop words included."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD_PATTERN), 0)


def is_stop_word(w: Column, language: str = "english") -> Column:
    # IN over a literal list becomes a hash-set lookup (InSet); an array
    # literal with array_contains would be a linear scan per word.
    return w.isin(stop_words(language))


def words(c: Column, language: str = "english") -> Column:
    """Lower-cased Unicode words minus stop words; duplicates are kept."""
    return F.filter(raw_words(c), lambda w: ~is_stop_word(w, language))


def stop_words_sql(language: str = "english") -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in stop_words(language)) + "]"


def words_sql(expr: str, language: str = "english") -> str:
    """DuckDB text of :func:`words`."""
    return (f"list_filter(regexp_extract_all(lower({expr}), '{WORD_PATTERN}'), "
            f"lambda w: not list_contains({stop_words_sql(language)}, w))")
