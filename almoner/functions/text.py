"""Name similarity: edit distance, word overlap and shared meaning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Abbreviations and their full forms.
ABBREVIATIONS = {
    "addr": "address",
    "st": "street",
    "ave": "avenue",
    "rd": "road",
    "dr": "drive",
    "ln": "lane",
    "blvd": "boulevard",
    "ct": "court",
    "apt": "apartment",
    "ste": "suite",
    "bldg": "building",
    "ph": "phone",
    "tel": "telephone",
    "mob": "mobile",
    "fax": "facsimile",
    "email": "electronic mail",
    "dob": "date of birth",
    "ssn": "social security number",
    "id": "identifier",
    "num": "number",
    "qty": "quantity",
    "amt": "amount",
    "org": "organization",
    "corp": "corporation",
    "co": "company",
    "dept": "department",
    "mgr": "manager",
    "rep": "representative",
    "info": "information",
    "desc": "description",
    "temp": "temporary",
    "pref": "preference",
    "req": "required",
    "opt": "optional",
    "vol": "volunteer",
    "mem": "member",
    "sub": "subscriber",
    "reg": "registration",
    "cert": "certificate",
    "qual": "qualification",
}
# Groups of words with a shared meaning.
SYNONYMS = {
    "address": ["location", "residence", "home", "place", "site"],
    "phone": ["telephone", "mobile", "cell", "contact"],
    "email": ["mail", "electronic_mail", "contact"],
    "name": ["title", "label", "designation"],
    "first_name": ["given_name", "forename"],
    "last_name": ["surname", "family_name"],
    "company": ["organization", "business", "employer", "corporation"],
    "donation": ["gift", "contribution", "pledge"],
    "volunteer": ["service", "help", "assist"],
    "member": ["subscriber", "participant", "supporter"],
    "event": ["activity", "program", "meeting"],
    "date": ["time", "when", "timestamp"],
    "amount": ["value", "total", "sum", "cost", "price"],
    "type": ["kind", "category", "classification"],
    "status": ["state", "condition", "situation"],
}
# Words that carry no meaning.
STOP_WORDS = ("a", "an", "the", "of", "for", "in", "on", "at", "to", "is", "are", "and", "or")


def expansions() -> dict[str, list[str]]:
    """Every word with an abbreviation or a synonym, and the words it brings along."""
    related: dict[str, set[str]] = {}
    for short, full in ABBREVIATIONS.items():
        related.setdefault(short, set()).add(full)
    for head, group in SYNONYMS.items():
        related.setdefault(head, set()).update(group)
        for word in group:
            related.setdefault(word, set()).update([head, *group])
    return {word: sorted(others) for word, others in sorted(related.items())}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times inside a higher-order expression."""
    return F.transform(F.array(value), body)[0]


def lev_sim(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; two empty strings are equal."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1.0 - F.levenshtein(a, b) / longest)


def split_words(c: Column, case_sensitive: bool = False) -> Column:
    """Words between _, - and spaces; camelCase also splits when case is kept."""
    text = F.regexp_replace(c, "([a-z])([A-Z])", "$1 $2") if case_sensitive else F.lower(c)
    return F.filter(F.split(text, r"[_\-\s]+"), lambda w: w != "")


def meaningful_words(c: Column) -> Column:
    """Lower-case words longer than two letters that are not stop words."""
    spaced = F.regexp_replace(c, "([a-z])([A-Z])", "$1 $2")
    words = F.split(F.lower(F.regexp_replace(spaced, r"[_\-\.]+", " ")), r"\s+")
    return F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(*STOP_WORDS))


def word_overlap(words_a: Column, words_b: Column) -> Column:
    """Sum over the words of A of the relation to the first related word of B, by the longer list.

    Equal words count 1, a prefix 0.8 and a contained word 0.6.
    """

    def relation(x: Column, y: Column) -> Column:
        return (
            F.when(x == y, 1.0)
            .when(F.startswith(x, y) | F.startswith(y, x), 0.8)
            .when(F.contains(x, y) | F.contains(y, x), 0.6)
        )

    def best(x: Column) -> Column:
        found = F.filter(F.transform(words_b, lambda y: relation(x, y)), lambda r: r.isNotNull())
        return F.coalesce(F.get(found, F.lit(0)), F.lit(0.0))

    total = F.aggregate(F.transform(words_a, best), F.lit(0.0), lambda acc, r: acc + r)
    longest = F.greatest(F.size(words_a), F.size(words_b))
    empty = (F.size(words_a) == 0) | (F.size(words_b) == 0)
    return F.when(empty, 0.0).otherwise(total / longest)


def fuzzy_parts(c: Column, case_sensitive: bool = False) -> Column:
    """What fuzzy_score needs from one side, so that it is prepared once per name."""
    text = c if case_sensitive else F.lower(c)
    return F.struct(text.alias("text"), split_words(c, case_sensitive).alias("words"))


def fuzzy_score_parts(a: Column, b: Column) -> Column:
    x, y = a["text"], b["text"]
    ratio = F.least(F.length(x), F.length(y)) / F.greatest(F.length(x), F.length(y))
    mixed = _let(
        F.struct(word_overlap(a["words"], b["words"]).alias("w"), lev_sim(x, y).alias("l")),
        lambda s: F.greatest(s["w"] * 0.7 + s["l"] * 0.3, s["w"], s["l"]),
    )
    return (
        F.when(x.isNull() | y.isNull() | (x == "") | (y == ""), 0.0)
        .when(x == y, 1.0)
        .when(F.startswith(x, y) | F.startswith(y, x), ratio * 0.9)
        .when(F.contains(x, y) | F.contains(y, x), ratio * 0.8)
        .otherwise(mixed)
    )


def fuzzy_score(a: Column, b: Column, case_sensitive: bool = False) -> Column:
    """Exact 1, prefix 0.9 and contained 0.8 by length ratio, else word overlap and edit distance."""
    return fuzzy_score_parts(fuzzy_parts(a, case_sensitive), fuzzy_parts(b, case_sensitive))


def expand_words(words: Column) -> Column:
    """Distinct words together with their full forms and synonyms."""
    related = expansions()
    pairs = [item for word, others in related.items() for item in (F.lit(word), F.array(*[F.lit(o) for o in others]))]
    table = F.create_map(*pairs)

    def expand(own: Column) -> Column:
        # the table is searched entry by entry, so only for words that it has
        added = F.transform(F.filter(own, lambda w: w.isin(*related)), lambda w: F.try_element_at(table, w))
        return F.array_distinct(F.concat(own, F.flatten(added)))

    return _let(words, expand)


def semantic_parts(c: Column) -> Column:
    return F.struct(F.lower(c).alias("text"), expand_words(meaningful_words(c)).alias("words"))


def semantic_score_parts(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a["words"], b["words"]))
    none = (F.size(a["words"]) == 0) | (F.size(b["words"]) == 0)
    return (
        F.when(a["text"] == b["text"], 1.0)
        .when(none, 0.0)
        .otherwise(both / (F.size(a["words"]) + F.size(b["words"]) - both))
    )


def semantic_score(a: Column, b: Column) -> Column:
    """Shared part of the two expanded word sets; equal names score 1, names without words 0."""
    return semantic_score_parts(semantic_parts(a), semantic_parts(b))
