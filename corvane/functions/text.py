"""Text, number, list and date functions of records."""

from __future__ import annotations

import html
import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

#: A short list of English function words; a parameter of clean_text.
STOPWORDS = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "were", "with")


def strip_tags(x: Column) -> Column:
    return F.regexp_replace(x, "<[^>]+>", " ")


def raw_tokens(x: Column) -> Column:
    """Lower-cased runs of letters and hyphens without markup, also empty and short ones."""
    return F.split(F.regexp_replace(F.lower(strip_tags(x)), "[^a-z\t\n-]+", " "), "[ \t\n]+")


def is_token(w: Column, stopwords: tuple[str, ...] = STOPWORDS, least: int = 3) -> Column:
    return (F.length(w) >= least) & ~w.isin(*stopwords)


def tokens(x: Column, stopwords: tuple[str, ...] = STOPWORDS, least: int = 3) -> Column:
    """Lower-cased words of letters and hyphens without markup, stopwords and words shorter than least."""
    return F.filter(raw_tokens(x), lambda w: is_token(w, stopwords, least))


def clean_text(x: Column, stopwords: tuple[str, ...] = STOPWORDS, lemma=None) -> Column:
    """Tokens joined by spaces, each lemmatised if lemma (one of the providers below) is given."""
    words = tokens(x, stopwords)
    return F.array_join(F.transform(words, lemma) if lemma else words, " ")


# Providers of lemmas: each is a function of a word. State with a score which one it used.
def identity(word: Column) -> Column:
    return word


def dictionary(lemmas: dict[str, str]):
    """Lemmas of a given list; other words stay."""
    return lambda w: F.coalesce(F.try_element_at(F.from_json(F.lit(json.dumps(lemmas)), "map<string, string>"), w), w)


def detached(word: Column) -> Column:
    """English endings taken off by rule: plurals of nouns first, then forms of verbs. Without a word list some results are no words."""
    noun = F.when(word.rlike("(ss|us|is)$"), word).when(word.rlike("(sses|shes|ches|xes|zes)$"), F.regexp_replace(word, "es$", "")).when(word.rlike("[^aeiou]ies$"), F.regexp_replace(word, "ies$", "y")).when(word.rlike("yses$"), F.regexp_replace(word, "es$", "is"))
    noun = noun.when(word.rlike("[a-z]{2,}s$"), F.regexp_replace(word, "s$", "")).otherwise(word)
    verb = F.when(word.rlike("[^aeiou]ied$"), F.regexp_replace(word, "ied$", "y")).when(word.rlike("[a-z]{3,}ed$"), F.regexp_replace(word, "ed$", "")).when(word.rlike("[a-z]{3,}ing$"), F.regexp_replace(word, "ing$", "")).otherwise(word)
    return F.when(noun != word, noun).otherwise(verb)


def lemma_tokens(x: Column, lemma=detached) -> Column:
    """The lemmas of those words of a text that are of a-z alone; null text has none."""
    words = F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit(r"([\p{L}\p{N}_]+)"))
    return F.transform(F.filter(words, lambda w: w.rlike("^[a-z]+$")), lemma)


def contains_sequence(words: Column, phrase: str) -> Column:
    """Whether the words hold the phrase's words in a row."""
    return F.lit(phrase != "") & F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")).contains(f" {phrase} ")


# Markup that strip_formatting takes off, applied in this order.
MARKUP = (
    (r"\*\*(.+?)\*\*", "$1"),
    (r"(?<!\w)\*(.+?)\*(?!\w)", "$1"),
    (r"(?<!\w)_(.+?)_(?!\w)", "$1"),
    (r"`([^`]+)`", "$1"),
    (r"^#{1,6}\s+", ""),
    (r"\[([^\]]+)\]\([^)]+\)", "$1"),
    (r"^>\s?", ""),
)


def strip_formatting(x: Column) -> Column:
    """Text without entities and markdown: bold, italic and code marks, headings, links (their label stays) and quotes; hyphens are spaces. Null is empty."""
    x = F.coalesce(unescape_once(x), F.lit(""))
    for pattern, to in MARKUP:
        x = F.regexp_replace(x, f"(?dmU){pattern}", to)
    return F.replace(x, F.lit("-"), F.lit(" "))


def jats_text(x: Column) -> Column:
    """An abstract's text without its markup, entities decoded and white space collapsed; null if nothing but a header word is left."""
    plain = F.trim(F.regexp_replace(unescape_once(F.regexp_replace(x, "<[^>]+>", " ")), r"\s+", " "))
    return F.when(~F.lower(plain).isin("", "abstract", "summary", "background"), plain)


def members(values: Column, wanted: list[str]) -> Column:
    """The values that are among wanted, case apart; null gives none."""
    low = [w.lower() for w in wanted]
    return F.coalesce(F.filter(values, lambda v: F.lower(v).isin(*low)), F.array().cast("array<string>"))


def in_batch(x: Column, names: list[str], prefixes: list[str]) -> Column:
    """Whether x is one of names or starts with one of prefixes, taken literally. ValueError if neither is given."""
    tests = ([x.isin(*names)] if names else []) + [x.startswith(p) for p in prefixes]
    if not tests:
        raise ValueError("neither names nor prefixes")
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return F.coalesce(out, F.lit(False))


def rendered(template: str, **fields: Column) -> Column:
    """The template with {name} replaced by the fields' text; null is empty."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.coalesce(fields[p].cast("string"), F.lit("")) if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def slugify(x: Column, most: int = 60) -> Column:
    return F.left(F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit(most))


def strict_year(x: Column) -> Column:
    """As year(), but what is neither blank nor a number fails the job."""
    return F.nullif(F.trim(x), F.lit("")).cast("double").cast("int")


def year(x: Column) -> Column:
    """'2012.0' and '2012' are 2012; what isn't a number is null."""
    return x.try_cast("double").try_cast("int")


def truth(x: Column) -> Column:
    low = F.lower(F.trim(x.cast("string")))
    return F.when(low.isin("y", "yes", "true"), True).when(low.isin("n", "no", "false"), False)


def json_list(x: Column) -> Column:
    """A list from its JSON; malformed or null: empty."""
    return F.coalesce(F.from_json(x, "array<string>"), F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    """Of two lists as sets; two empty ones have 1."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(union, F.lit(1)))


def shard_of(key: Column, shards: int) -> Column:
    return F.crc32(key.cast("binary")) % shards


def stamp(t: Column) -> Column:
    return F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def peak(t: Column, hours: tuple[tuple[int, int], ...] = ((1, 4), (6, 10))) -> Column:
    """UTC hours of the dear tariff from Monday to Friday."""
    busy = F.lit(False)
    for low, high in hours:
        busy = busy | ((F.hour(t) >= low) & (F.hour(t) < high))
    return busy & (F.weekday(t) < 5)


def next_peak(t: Column, hours: tuple[tuple[int, int], ...] = ((1, 4), (6, 10))) -> Column:
    """The next full hour at which a dear tariff begins."""
    whole = F.date_trunc("hour", t)
    ahead = F.sequence(whole + F.expr("interval 1 hour"), whole + F.expr("interval 192 hours"), F.expr("interval 1 hour"))
    return F.get(F.filter(ahead, lambda h: peak(h, hours) & ~peak(h - F.expr("interval 1 hour"), hours)), F.lit(0))


def next_off_peak(t: Column, hours: tuple[tuple[int, int], ...] = ((1, 4), (6, 10))) -> Column:
    """t itself outside the dear tariff, else the full hour at which it ends."""
    whole = F.date_trunc("hour", t)
    ahead = F.sequence(whole, whole + F.expr("interval 24 hours"), F.expr("interval 1 hour"))
    return F.greatest(F.get(F.filter(ahead, lambda h: ~peak(h, hours)), F.lit(0)), t)


def fits_off_peak(t: Column, minutes: int, hours: tuple[tuple[int, int], ...] = ((1, 4), (6, 10))) -> Column:
    """Whether a run of so many minutes from t stays outside the dear tariff, looked at every 15 minutes and at its end."""
    end = t + F.expr(f"interval {minutes} minutes")
    steps = F.sequence(t, end - F.expr("interval 1 microsecond"), F.expr("interval 15 minutes"))
    return ~F.exists(steps, lambda s: peak(s, hours)) & ~peak(end, hours)


@pandas_udf(StringType())
def unescape_once(x: pd.Series) -> pd.Series:
    """HTML entities decoded. There is no built-in for it."""
    return x.map(lambda s: html.unescape(s) if s is not None and "&" in s else s, na_action="ignore")


_ENTITY = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")


@pandas_udf(StringType())
def unescape(x: pd.Series) -> pd.Series:
    """HTML entities decoded until nothing changes, three passes at most; only one that ends in a semicolon starts a pass. There is no built-in for it."""

    def one(s):
        for _ in range(3):
            if s is None or not _ENTITY.search(s):
                return s
            s = html.unescape(s)
        return s

    return x.map(one, na_action="ignore")
