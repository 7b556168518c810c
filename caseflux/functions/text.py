"""Column functions of free text: term counts, magnitudes, dates, cuts, links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
MONTH_WORDS = "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"


def term_count(text: Column, terms: tuple[str, ...]) -> Column:
    """How many of ``terms`` stand in the text as whole words, each once."""
    low = F.lower(F.coalesce(text, F.lit("")))
    hits = [F.when(low.rlike("\\b" + t.replace(".", "\\.") + "\\b"), 1).otherwise(0) for t in terms]
    return sum(hits[1:], hits[0])


def word_jaccard(a: Column, b: Column) -> Column:
    """Shared share of the blank-separated lower-case words; 0 where both are empty."""
    split = lambda c: F.array_distinct(F.filter(F.split(F.trim(F.lower(F.coalesce(c, F.lit("")))), "\\s+"), lambda w: w != ""))
    x, y = split(a), split(b)
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(x, y)) / union)


def magnitude(c: Column) -> Column:
    """Number of a text such as ``1.5 million`` or ``20k``; null without digits."""
    t = F.replace(F.lower(F.trim(c)), F.lit(","), F.lit(""))
    unit = F.when(t.contains("billion") | t.endswith("b"), 1e9).when(t.contains("million") | t.endswith("m"), 1e6).when(t.contains("thousand") | t.endswith("k"), 1e3).otherwise(1.0)
    return F.nullif(F.regexp_extract(t, "[-+]?\\d*\\.?\\d+", 0), F.lit("")).cast("double") * unit


def month_number(name: Column) -> Column:
    at = F.instr(F.lit(_MONTHS), F.lower(F.substring(name, 1, 3)))
    return F.when((at > 0) & (at % 3 == 1), ((at + 2) / 3).cast("int"))


def _day(y: Column, m: Column, d: Column) -> Column:
    """Date with the day cut to the month's length (February: 28); null for a wrong month or year."""
    y, m, d = y.try_cast("int"), m.try_cast("int"), d.try_cast("int")
    longest = F.when(m == 2, 28).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
    ok = y.between(1995, 2100) & m.between(1, 12) & (d >= 1)
    return F.when(ok, F.format_string("%04d-%02d-%02d", y, m, F.least(d, longest)))


def _with(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def _date_of_words(words: Column, forms: tuple[str, ...]) -> Column:
    """Date of the first run of words of a form: D a day, M a month's name, N its number, Y a year."""
    is_a = {
        "D": lambda w: w.rlike("^[0-9]{1,2}(?:st|nd|rd|th)?$"),
        "M": lambda w: w.rlike(f"^{MONTH_WORDS}$"),
        "N": lambda w: w.rlike("^(?:0?[1-9]|1[0-2])$"),
        "Y": lambda w: w.rlike("^(?:19|20)[0-9]{2}$"),
    }

    def dated(w: Column) -> Column:
        def fits(form: str):
            return lambda i: F.coalesce(reduce(lambda x, y: x & y, [is_a[c](F.try_element_at(w, i + F.lit(k))) for k, c in enumerate(form)]), F.lit(False))

        def day_at(form: str):
            def day(i: Column) -> Column:
                part = {c: F.try_element_at(w, i + F.lit(k)) for k, c in enumerate(form)}
                month = month_number(part["M"]) if "M" in part else part["N"]
                return F.when(i.isNotNull(), _day(part["Y"], month, F.regexp_replace(part["D"], "[a-z]+", "") if "D" in part else F.lit("1")))

            return day

        places = F.when(F.size(w) > 0, F.sequence(F.lit(1), F.size(w)))
        return F.coalesce(*(_with(F.try_element_at(F.filter(places, fits(form)), F.lit(1)), day_at(form)) for form in forms))

    return _with(words, dated)


def _words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0))


def first_date(text: Column) -> Column:
    """First explicit date: ISO, day month year, month day year, month year (its first day), in this order."""
    iso = F.split(F.regexp_extract(text, "\\b((?:19|20)[0-9]{2}-[0-9]{1,2}-[0-9]{1,2})\\b", 1), "-")
    whole = F.when(F.size(iso) == 3, _day(F.try_element_at(iso, F.lit(1)), F.try_element_at(iso, F.lit(2)), F.try_element_at(iso, F.lit(3))))
    return F.coalesce(whole, _date_of_words(_words(text), ("DMY", "MDY", "MY")))


def url_host(c: Column) -> Column:
    """Host of a URL without ``www.``; null for what is no URL."""
    return F.regexp_replace(F.nullif(F.regexp_extract(F.lower(c), "^[a-z]+://([^/:?#]+)", 1), F.lit("")), "^www\\.", "")


def url_date(c: Column) -> Column:
    """Publication date in the path of a URL: year, month, day; day, month's name, year; month's name, year; year, month."""
    return _date_of_words(_words(F.regexp_replace(c, "^[a-zA-Z]+://[^/]*", "")), ("YND", "DMY", "MY", "YN"))


def cut_at_sentence(c: Column, limit: int) -> Column:
    """At most ``limit`` characters, up to a sentence end in the last 30 %, else the last word and an ellipsis."""
    head = F.substring(c, 1, limit)
    stop = F.length(head) - F.instr(F.reverse(head), ".") + 1
    at_word = F.concat(F.regexp_replace(head, "\\s+\\S*$", ""), F.lit("…"))
    return F.when(F.length(c) <= limit, c).when((F.instr(head, ".") > 0) & (stop >= 0.7 * limit), F.substring(head, F.lit(1), stop)).otherwise(at_word)


def printable(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, "[\\p{Cc}\\p{Cf}]", " "), "\\s+", " "))


def pair_key(a: Column, b: Column) -> Column:
    """The same key for (a, b) and (b, a), in text order."""
    return F.concat_ws("|", F.least(a, b), F.greatest(a, b))
