"""Column functions of organisation names: normal form, keys, tokens, similarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal forms that a key leaves out, and words that identify nobody.
LEGAL_FORMS = (
    "proprietary limited", "pty limited", "pty ltd", "limited liability company", "public limited company", "incorporated", "corporation", "company", "limited", "ltd", "llc", "plc", "inc", "gmbh", "nv", "ag", "sa", "srl",
)
GENERIC = (
    "the", "of", "and", "for", "australia", "australian", "aust", "au", "group", "holdings", "services", "service", "solutions", "systems", "co", "motor", "financial", "national", "international", "global",
    "pty", "ltd", "limited", "inc", "corporation", "company", "department", "government", "state", "new", "south", "north", "west", "east",
)
_ACCENTED = "àáâãäåāçćčèéêëēìíîïīñńòóôõöøōùúûüūýÿžźšśł"
_PLAIN = "aaaaaaaccceeeeeiiiiinnooooooouuuuuyyzzssl"


def normal_name(c: Column) -> Column:
    """Lower case, accents off, ``&`` written out, punctuation to blanks; empty for null."""
    t = F.translate(F.lower(F.coalesce(c, F.lit(""))), _ACCENTED, _PLAIN)
    t = F.regexp_replace(F.replace(t, F.lit("&"), F.lit(" and ")), "[^\\p{L}\\p{N}_\\s]+", " ")
    return F.trim(F.regexp_replace(t, "\\s+", " "))


def name_key(c: Column) -> Column:
    """Normal form without trailing legal forms; a name is never reduced to nothing."""
    forms = "|".join(LEGAL_FORMS)
    return F.regexp_replace(normal_name(c), f"(?<=\\S)( ({forms}))+$", "")


def name_tokens(c: Column) -> Column:
    """Words of the key that are not generic, in order."""
    return F.filter(F.split(name_key(c), " "), lambda w: ~w.isin(*GENERIC) & (w != ""))


def token_similarity(a: Column, b: Column) -> Column:
    """max(Jaccard, 0.95 x containment) of two token arrays; 0 where either is empty."""
    a, b = F.array_distinct(a), F.array_distinct(b)
    both = F.size(F.array_intersect(a, b))
    jaccard, contained = both / F.size(F.array_union(a, b)), 0.95 * both / F.least(F.size(a), F.size(b))
    return F.when(both == 0, 0.0).otherwise(F.greatest(jaccard, contained))


def initials(tokens: Column) -> Column:
    return F.array_join(F.transform(tokens, lambda w: F.substring(w, 1, 1)), "")


def blocking_keys(c: Column, rare: Column | None = None) -> Column:
    """Keys under which a name meets its variants.

    The key, all telling words, their first two, each rare word (``rare``: an
    array; without it the first telling word) and initials of three or more.
    """
    key, words = name_key(c), name_tokens(c)
    single = F.slice(words, 1, 1) if rare is None else F.array_intersect(words, rare)
    acronym = F.when((F.size(F.split(key, " ")) >= 3) & (F.length(initials(words)) >= 3), F.array(initials(words))).otherwise(F.array().cast("array<string>"))
    pair = F.when(F.size(words) >= 2, F.array(F.array_join(F.slice(words, 1, 2), " "))).otherwise(F.array().cast("array<string>"))
    keys = F.concat(F.array(key), F.array(F.array_join(words, " ")), pair, single, acronym)
    return F.filter(F.array_distinct(keys), lambda k: (k != "") & ~k.isin(*GENERIC))


# Places that trail a name without being part of it.
PLACES = ("australia", "aust", "au", "nsw", "vic", "qld", "wa", "sa", "tas", "act", "nt", "new south wales", "victoria", "queensland", "tasmania", "usa", "uk", "new zealand", "nz")


def without_place(c: Column) -> Column:
    """Normal form without parentheses and without trailing places, unless "of" precedes them."""
    t = normal_name(F.regexp_replace(F.coalesce(c, F.lit("")), "\\([^)]*\\)", " "))
    return F.regexp_replace(t, f"(?<=\\S)(?<! of)( ({'|'.join(PLACES)}))+$", "")


def split_compound(c: Column, most_words: int = 6) -> Column:
    """Names joined by ``,``, ``;``, ``|`` or ``/``; "and" and "&" part only names of few words."""
    parts = F.split(F.coalesce(c, F.lit("")), "\\s*[,;|/]\\s*")
    short = lambda p: F.size(F.split(F.trim(p), "\\s+")) <= most_words
    finer = F.flatten(F.transform(parts, lambda p: F.when(short(p), F.split(p, "(?i)\\s+(?:and|&)\\s+")).otherwise(F.array(p))))
    return F.array_distinct(F.filter(F.transform(finer, lambda p: F.trim(p)), lambda p: p != ""))


def is_initialism(short: Column, long: Column) -> Column:
    """Is the short name made of the first letters of the long one's words (all, or without "of", "and", "the")?"""
    s = F.replace(normal_name(short), F.lit(" "), F.lit(""))
    words = F.split(normal_name(long), " ")
    telling = F.filter(words, lambda w: ~w.isin("of", "and", "the", "for"))
    return (F.length(s) >= 2) & (F.size(words) >= 2) & ((s == initials(words)) | (s == initials(telling)))


def distinctive_core(tokens: Column, common: Column) -> Column:
    """Tokens of three letters or more that are not among the common ones."""
    return F.array_distinct(F.filter(F.array_except(tokens, common), lambda w: F.length(w) >= 3))
