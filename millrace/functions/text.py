"""Text and name functions as column expressions; missing values are NULL, never NaN."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Fixed values.
STOPWORDS = tuple(
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself "
    "they them their theirs themselves what which who whom this that these those am is are was were be been being have has had "
    "having do does did doing a an the and but if or because as until while of at by for with about against between into through "
    "during before after above below to from up down in out on off over under again further then once here there when where why "
    "how all any both each few more most other some such no nor not only own same so than too very s t can will just don should now".split()
)
VENUE_STOPWORDS = (*STOPWORDS, *"proceedings journal conference transactions international society letters official research association".split())
NAME_PREFIXES = ("dr", "prof", "professor", "mr", "miss", "mrs", "ms", "mx", "sir", "phd", "md", "doctor")
# Latin letters that do not decompose, with their usual spelling.
LATIN = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "þ": "th", "Þ": "Th", "ı": "i", "’": "'", "‘": "'", "`": "'"}
# What letters with marks decompose to, in the order of the letters.
_MARKED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿĀāĂăĄąĆćČčĎďĒēĖėĘęĚěĞğĪīİŃńŇňŌōŐőŘřŚśŞşŠšŢţŤťŪūŮůŰűŹźŻżŽž"


def ascii_letters(text: Column) -> Column:
    """Latin letters without their marks; others stay (and normalising drops them)."""
    import unicodedata

    plain = "".join(unicodedata.normalize("NFD", c)[0] for c in _MARKED)
    out = F.translate(text, _MARKED, plain)
    for a, b in LATIN.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.regexp_replace(out, r"\p{M}+", "")


def normalize_text(text: Column, join_apostrophes: bool = False) -> Column:
    """Lower-case a-z words parted by single spaces; NULL and empty give ''."""
    t = F.lower(ascii_letters(F.coalesce(text, F.lit(""))))
    if join_apostrophes:
        t = F.replace(t, F.lit("'"), F.lit(""))
    return F.trim(F.regexp_replace(t, "[^a-z]+", " "))


def let(value: Column, use) -> Column:
    """use(value) with value computed once: a lambda that holds an expression would compute it for each element."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), 0)


def words(text: Column) -> Column:
    """Words between spaces, without empty ones."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), " "), lambda w: w != "")


def split_first_middle(first: Column, middle: Column) -> Column:
    """struct(first, middle): one honorific is dropped; without a hyphen in the raw first name, its further words go to the middle."""
    f = words(normalize_text(first, True))
    f = F.when(F.get(f, 0).isin(*NAME_PREFIXES), F.slice(f, 2, F.greatest(F.size(f) - 1, F.lit(0)))).otherwise(f)
    m = words(normalize_text(middle))
    hyphen = F.coalesce(F.contains(first, F.lit("-")), F.lit(False))
    spill = F.when(hyphen | (F.size(f) == 0), m).otherwise(F.concat(F.slice(f, 2, F.greatest(F.size(f) - 1, F.lit(0))), m))
    kept = F.when(hyphen, F.array_join(f, " ")).otherwise(F.coalesce(F.get(f, 0), F.lit("")))
    return F.struct(kept.alias("first"), F.array_join(spill, " ").alias("middle"))


def char_ngrams(text: Column, unigrams: bool = False, bigrams: bool = True, stopwords: tuple[str, ...] | None = STOPWORDS) -> Column:
    """Array (a multiset) of character n-grams up to 4 that cross no space; with stopwords, these and words up to two letters are dropped first."""
    t = F.coalesce(text, F.lit(""))
    if stopwords is not None:
        keep = F.filter(F.split(t, " "), lambda w: ~w.isin(*stopwords) & (F.length(w) > 2))
        t = F.array_join(keep, " ")
    sizes = [1] * unigrams + [2] * bigrams + [3, 4]
    return let(t, lambda x: F.concat(*(_grams(x, F.length(x), size) for size in sizes)))


def _grams(t: Column, n: Column, size: int) -> Column:
    each = F.transform(F.sequence(F.lit(1), F.greatest(n - (size - 1), F.lit(1))), lambda i: t.substr(i, F.lit(size)))
    return F.filter(each, lambda g: (F.length(g) == size) & ~F.contains(g, F.lit(" ")))


def word_ngrams(text: Column, stopwords: tuple[str, ...] = STOPWORDS) -> Column:
    """Array (a multiset) of one to three words in a row, after stopwords and single letters are dropped."""
    w = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda x: ~x.isin(*stopwords) & (F.length(x) > 1))
    return let(w, lambda x: F.concat(x, *(_word_runs(x, k) for k in (2, 3))))


def _word_runs(w: Column, k: int) -> Column:
    each = F.transform(w, lambda x, i: F.when(i + k <= F.size(w), F.array_join(F.slice(w, i + 1, k), " ")))
    return F.filter(each, lambda g: g.isNotNull())


def counts(grams: Column) -> Column:
    """Map from gram to count."""
    return let(grams, lambda all_: F.map_from_entries(F.transform(F.array_distinct(all_), lambda g: F.struct(g, F.size(all_) - F.size(F.array_remove(all_, g))))))


def occurrences(grams: Column) -> Column:
    """A multiset as distinct strings, gram and number of the occurrence: set functions then count as multisets do."""
    number = lambda o: F.transform(o, lambda g, i: F.concat(g, F.lit("\t"), (i + 2 - F.array_position(o, g)).cast("string")))
    return let(F.array_sort(grams), number)


# ---------------------------------------------------------------- pair functions
def multiset_jaccard(a: Column, b: Column, most: float | None = None) -> Column:
    """counter_jaccard of two multisets given as occurrences."""
    shared = F.size(F.array_intersect(a, b))
    union = (F.size(a) + F.size(b) - shared).cast("double")
    bottom = F.least(union, F.lit(float(most))) if most else union
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.least(shared / bottom, F.lit(1.0)))


def counter_jaccard(a: Column, b: Column, most: float | None = None) -> Column:
    """Multiset Jaccard of two count maps: shared over united, at most 1, the denominator at most `most`; NULL if either is empty."""
    shared = F.aggregate(F.map_entries(a), F.lit(0), lambda acc, e: acc + F.least(e["value"], F.coalesce(F.element_at(b, e["key"]), F.lit(0))))
    total = lambda m: F.aggregate(F.map_values(m), F.lit(0), lambda acc, v: acc + v)
    union = total(a) + total(b) - shared
    bottom = F.least(union.cast("double"), F.lit(float(most))) if most else union.cast("double")
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.least(shared / bottom, F.lit(1.0)))


def jaccard(a: Column, b: Column) -> Column:
    """Set Jaccard; NULL if either is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def _filled(*cols: Column) -> Column:
    ok = F.lit(True)
    for c in cols:
        ok = ok & c.isNotNull() & (F.length(c) > 0)
    return ok


def equal(a: Column, b: Column) -> Column:
    """1 or 0 by lower-case equality; NULL if one is missing or a dash."""
    same = F.lower(F.regexp_replace(a, r"^\s+|\s+$", "")) == F.lower(F.regexp_replace(b, r"^\s+|\s+$", ""))
    return F.when(_filled(a, b) & (a != "-") & (b != "-"), same.cast("int"))


def equal_middle(a: Column, b: Column) -> Column:
    """As equal, by initials if either is one; case counts."""
    initial = (F.length(a) == 1) | (F.length(b) == 1)
    return F.when(_filled(a, b), F.when(initial, F.left(a, F.lit(1)) == F.left(b, F.lit(1))).otherwise(a == b).cast("int"))


def equal_initial(a: Column, b: Column) -> Column:
    return F.when(_filled(a, b), (F.left(F.lower(F.trim(a)), F.lit(1)) == F.left(F.lower(F.trim(b)), F.lit(1))).cast("int"))


def same_prefix_tokens(a: Column, b: Column) -> Column:
    """Of each aligned pair of words one begins the other; true if either has none."""
    x, y = words(a), words(b)
    n = F.least(F.size(x), F.size(y))
    pairs = F.zip_with(F.slice(x, 1, n), F.slice(y, 1, n), lambda p, q: p.startswith(q) | q.startswith(p))
    return F.forall(pairs, lambda ok: ok)


def prefix_distance(a: Column, b: Column) -> Column:
    """1 less the common prefix over the shorter length; 0 if equal."""
    n = F.least(F.length(a), F.length(b))
    common = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), lambda acc, i: F.when((i <= n) & (F.left(a, i) == F.left(b, i)), i).otherwise(acc))
    return F.when(a == b, 0.0).when(common == 0, 1.0).otherwise(1 - common / n)


def levenshtein_share(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))


def _lcs(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def _jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken = [False] * len(b)
    mine = []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == x:
                taken[j] = True
                mine.append(x)
                break
    theirs = [y for y, t in zip(b, taken) if t]
    m = len(mine)
    if not m:
        return 0.0
    jaro = (m / len(a) + m / len(b) + (m - sum(x != y for x, y in zip(mine, theirs)) // 2) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


@F.pandas_udf(DoubleType())
def lcs_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """1 less the longest common subsequence over the longer length."""
    return pd.Series([None if x is None or y is None else 0.0 if x == y else 1 - _lcs(x, y) / max(len(x), len(y)) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else _jaro_winkler(x, y) for x, y in zip(a, b)], dtype="float64")


def name_text_features(a: Column, b: Column) -> list[Column]:
    """Levenshtein share, prefix, subsequence distance, Jaro-Winkler; NULL unless both have two letters."""
    ok = F.coalesce((F.length(a) > 1) & (F.length(b) > 1), F.lit(False))
    return [F.when(ok, f(a, b)) for f in (levenshtein_share, prefix_distance, lcs_distance, jaro_winkler)]


def cosine(a: Column, b: Column) -> Column:
    """Cosine in double precision, 0 if either norm is 0."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms == 0, 0.0).otherwise(F.try_divide(dot(a, b), norms))


def difference(a: Column, b: Column, most: float | None = None) -> Column:
    d = F.abs(a.cast("double") - b.cast("double"))
    return F.when(d.isNotNull(), F.least(d, F.lit(float(most)))) if most else d


def compute_block(name: Column) -> Column:
    """First initial and last word; a single word is its own block."""
    parts = F.split(F.coalesce(name, F.lit("")), " ")
    return F.when(F.size(parts) == 1, F.get(parts, 0)).otherwise(F.concat(F.left(F.get(parts, 0), F.lit(1)), F.lit(" "), F.element_at(parts, -1)))


def email_parts(email: Column) -> Column:
    """struct(prefix, suffix) by the last @, without dots at the ends, lower case; NULL without an address."""
    has = _filled(email)
    full = F.when(F.contains(email, F.lit("@")), email).otherwise(F.concat(email, F.lit("@MISSING")))
    strip = lambda x: F.lower(F.regexp_replace(x, r"^\.+|\.+$", ""))
    suffix = F.substring_index(full, "@", -1)
    prefix = F.replace(F.substring(full, 1, F.length(full) - F.length(suffix) - 1), F.lit("@"), F.lit(""))
    return F.when(has, F.struct(strip(prefix).alias("prefix"), strip(suffix).alias("suffix")))


def orcid(sources: Column) -> Column:
    """First 16-character identifier of an array of source ids, without dashes, upper case."""
    found = F.transform(sources, lambda s: F.upper(F.replace(F.regexp_extract(s, r"(\d{4}-?\d{4}-?\d{4}-?\d{3}[\dXx])", 1), F.lit("-"), F.lit(""))))
    return F.get(F.filter(found, lambda s: s != ""), 0)


def full_name(first: Column, middle: Column, last: Column, suffix: Column | None = None) -> Column:
    """The parts that are not empty, joined by spaces."""
    parts = [first, middle, last] + ([suffix] if suffix is not None else [])
    return F.array_join(F.filter(F.array(*parts), lambda p: p.isNotNull() & (F.length(p) > 0)), " ")


def lasts_equivalent(a: Column, b: Column) -> Column:
    """Equal but for spaces."""
    return F.replace(F.coalesce(a, F.lit("")), F.lit(" "), F.lit("")) == F.replace(F.coalesce(b, F.lit("")), F.lit(" "), F.lit(""))


def f1(p: Column, r: Column) -> Column:
    return F.when((p == 0) | (r == 0), 0.0).otherwise(F.try_divide(2 * p * r, p + r))
