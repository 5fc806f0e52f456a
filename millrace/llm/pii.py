"""Personal data: identifiers by pattern, and terms that give them away by corpus statistics.

Base spans are e-mail addresses, IPv4 addresses, payment cards (Luhn) and phone numbers.
Their values are the protected entities. A term discloses an entity as far as knowing the
term tells that the entity is there: pointwise mutual information over the entity's information
content, log2((n(t,e) - ``DISCOUNT``) * N / (n(t) * n(e))) / log2(N / n(e)), from counts of
documents (rows, copies included) over the whole corpus. It is near 1 for a term that occurs
nowhere without the entity, also for one that both stand in a single document; the discount of
the joint count keeps such single sightings below certainty. Terms are the words outside
identifiers of four letters or more, and shorter ones (two letters at least) that begin with a
capital or belong to a script without case. n(t,e) counts the documents that hold both, wherever
they stand. Terms that reach ``GENERALISE`` are generalised, from ``REMOVE`` on removed, in every
document that holds them, with the identifier or without.

All steps are DataFrame functions. Words and entities each have a list of the most frequent ones, of
``FREQUENT`` entries at most; W occurrences in all have at most that many that occur more
than W / FREQUENT times, so what is not listed is rare. The lists are broadcast. A pair of a frequent term and an entity goes on
only if the entity's count (for others: the most that one not listed can have) lets the term reach
the threshold; words not listed, few occurrences in all, are shuffled by the word. So no key holds
more than its share, hot entities meet their terms in the map, and text is shuffled only of the
documents that hold a disclosing term (by a bitmap of fixed size, then exactly).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import common as C

GENERALISE, REMOVE = 0.8, 0.95
DISCOUNT = 0.5
FREQUENT = 100_000
KINDS = ("email", "ip", "card", "phone")
# The contract's patterns. Repeated groups are possessive (nothing that follows could use what they
# give up, so the matches are the same): they run in a loop and not on the stack. An address's local
# part is only tried where a run of its characters begins or the last match ended, an IP's first part
# where a run of digits begins; a match of an IP always ends with its run.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
WORD = r"\p{L}+"
#: Words that can be terms, as they stand in a text.
TERM = r"^(?:\p{L}{4,}|[\p{Lu}\p{Lt}\p{Lo}]\p{L}+)$"
SPANS = "array<struct<start:int,ord:int,end:int,value:string>>"


def _let(value: Column, use) -> Column:
    """use(value) with the value computed once."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), 0)


def places(matches: Column, gaps: Column) -> Column:
    """Array of (start, end, value) in code points, from the matches and the pieces between them.

    Running sums are taken in blocks of about the root of the number of matches, and over the blocks."""
    kind = "array<struct<start:int,end:int,value:string>>"
    zero = F.struct(F.lit(0).alias("pos"), F.array().cast(kind).alias("out"))

    def step(acc, i):
        s = acc["pos"] + F.length(F.get(gaps, i))
        e = s + F.length(F.get(matches, i))
        return F.struct(e.alias("pos"), F.concat(acc["out"], F.array(F.struct(s.alias("start"), e.alias("end"), F.get(matches, i).alias("value")))).alias("out"))

    def block(k, size):
        return F.aggregate(F.sequence(k * size, F.least((k + 1) * size, F.size(matches)) - 1), zero, step)

    def whole(blocks):
        def add(acc, b):
            moved = F.transform(b["out"], lambda x: F.struct((x["start"] + acc["pos"]).alias("start"), (x["end"] + acc["pos"]).alias("end"), x["value"].alias("value")))
            return F.struct((acc["pos"] + b["pos"]).alias("pos"), F.concat(acc["out"], F.array(moved)).alias("out"))

        start = F.struct(F.lit(0).alias("pos"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.aggregate(blocks, start, add, lambda acc: F.flatten(acc["out"]))

    size = F.ceil(F.sqrt(F.size(matches))).cast("int")
    found = _let(size, lambda n: _let(F.transform(F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / n).cast("int")), lambda k: block(k, n)), whole))
    return F.when(F.size(matches) > 0, found).otherwise(F.array().cast(kind))


def _luhn(digits: Column) -> Column:
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((2 * d.cast("int")) % 10 + F.floor(d.cast("int") / 5).cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _passes(kind: str, v: Column) -> Column:
    if kind == "ip":
        part = lambda x: F.regexp_replace(x, "^0+", "")
        return F.forall(F.split(v, r"\."), lambda x: (F.length(part(x)) < 3) | ((F.length(part(x)) == 3) & (part(x) <= "255")))
    if kind == "card":
        digits = F.regexp_replace(v, "[ -]", "")
        return F.length(digits).between(12, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(F.regexp_replace(v, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _kept(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda x: _passes(kind, x["value"]))


def _tagged(n: int, name: str) -> Column:
    return F.transform(name, lambda x: F.struct(x["start"].alias("start"), F.lit(n).alias("ord"), x["end"].alias("end"), x["value"].alias("value")))


def base_spans(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, fp, text, n_<kind>..., base): spans by start, then kind as listed; base holds (start, ord, end, value)."""
    rows = docs.select(docs[key].cast("long").alias("doc_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    hint = {"email": F.contains(F.col("text"), F.lit("@")), "phone": F.contains(F.col("text"), F.lit("+"))}
    none = F.array().cast("array<string>")
    rows = rows.select("*", *(F.when(hint.get(k, F.lit(True)), F.regexp_extract_all("text", F.lit(PATTERNS[k]), F.lit(0))).otherwise(none).alias(f"m_{k}") for k in KINDS))
    rows = rows.select("*", *(F.when(F.size(f"m_{k}") > 0, F.split("text", PATTERNS[k], -1)).alias(f"g_{k}") for k in KINDS))
    found = [_kept(k, places(F.col(f"m_{k}"), F.col(f"g_{k}"))).alias(f"s_{k}") for k in KINDS]
    rows = rows.select("doc_id", "text", *found)
    tagged = [_tagged(n, f"s_{k}") for n, k in enumerate(KINDS)]
    return rows.select("doc_id", F.xxhash64("text").alias("fp"), "text", *(F.size(f"s_{k}").cast("long").alias(f"n_{k}") for k in KINDS), F.array_sort(F.concat(*tagged)).alias("base"))


def _rebuilt(text: Column, spans: Column, mask) -> Column:
    """A text with mask(span, start, end) in place of each span's part that no earlier one covers."""

    def step(acc, b):
        s, e = F.greatest(b["start"], acc["pos"]), F.greatest(b["end"], acc["pos"])
        piece = F.substring(text, acc["pos"] + 1, s - acc["pos"])
        return F.struct(e.alias("pos"), F.concat(acc["out"], F.array(piece, mask(b, s, e))).alias("out"))

    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))
    rest = F.aggregate(spans, start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["pos"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, rest).otherwise(text)


def _outside(text: Column, base: Column) -> Column:
    """A text with blanks for each identifier: all else keeps its place."""
    return _rebuilt(text, base, lambda b, s, e: F.repeat(F.lit(" "), e - s))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _distinct_words(base: DataFrame) -> Column:
    """The different words outside identifiers, lower-cased."""
    return F.array_distinct(_words(F.lower(_outside(F.col("text"), F.col("base")))))


def disclosing_terms(held: DataFrame, n_t: DataFrame, total: int, frequent: DataFrame, most: int = FREQUENT) -> DataFrame:
    """(term, disclosure) for terms that give away some entity.

    held: (entities, terms) of the documents with an identifier; n_t: (term, n_t) of all
    documents; frequent: (term, n_t) of the listed words."""
    n_e = C.materialize(held.select(F.explode("entities").alias("en")).groupBy("en").agg(F.count("*").alias("n_e")), "entities")
    hot, bound = C.listed(n_e, "n_e", most)

    def disclosure(n_te, t, e):
        return F.log2((n_te - DISCOUNT) * total / (t * e)) / F.nullif(F.log2(F.lit(float(total)) / e), F.lit(0.0))

    pairs = held.select(F.explode("entities").alias("entity"), "terms").join(F.broadcast(hot), F.col("entity") == F.col("en"), "left").select("entity", "n_e", F.explode("terms").alias("term"))
    pairs = pairs.join(F.broadcast(frequent.select(F.col("term").alias("w"), F.col("n_t").alias("n_f"))), F.col("term") == F.col("w"), "left")
    # what a term can reach at best: with an entity of which n_e is only bounded, if they share all their documents
    most_e = F.least(F.lit(max(1, bound)), "n_f")
    best = F.when(F.col("n_e").isNull(), disclosure(most_e, F.col("n_f"), most_e)).otherwise(disclosure(F.least("n_e", "n_f"), F.col("n_f"), F.col("n_e")))
    able = F.col("n_f").isNull() | (best >= GENERALISE - 1e-9)
    pairs = pairs.where(able).groupBy("entity", "term", "n_e", "n_f").agg(F.count("*").alias("n_te"))
    pairs = C.materialize(pairs, "pairs")
    rest = pairs.where("n_e is null").drop("n_e").join(n_e, F.col("entity") == F.col("en")).select("term", "n_e", "n_f", "n_te")
    both = pairs.where("n_e is not null").select("term", "n_e", "n_f", "n_te").unionByName(rest)
    # at most one row of each pair of counts in a task for each term before it meets the term's own count
    both = both.groupBy("term", "n_e", "n_f", "n_te").agg(F.lit(1).alias("x"))
    known = both.where("n_f is not null").select("term", "n_e", "n_te", F.col("n_f").alias("n_t"))
    both = known.unionByName(both.where("n_f is null").join(n_t, "term").select("term", "n_e", "n_te", "n_t"))
    told = both.where(F.col("n_e") < total).withColumn("disclosure", disclosure(F.col("n_te"), F.col("n_t"), F.col("n_e"))).where(F.col("disclosure") >= GENERALISE)
    return C.materialize(told.groupBy("term").agg(F.max("disclosure").alias("disclosure")), "told")


def sanitise(docs: DataFrame, text: str = "text", key: str = "doc_id", with_text: bool = True, most: int = FREQUENT) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms (and sanitised), one row per input row.

    spans: kind:start:end of base spans and of terms (kind `generalise` or `remove`), by
    start, then kind; sanitised: the text with base spans as [EMAIL] and so on, terms as
    [TERM] or left out, for texts that hold a base span or a term, else null. Null texts count as empty.
    Rows that repeat an id and text have the same result and count each; columns of other names play no part.
    """
    base = base_spans(docs, text, key)
    value = lambda b: F.when(b["ord"] == 0, F.lower(b["value"])).when(b["ord"] == 1, b["value"]).otherwise(F.regexp_replace(b["value"], "[^0-9]", ""))
    entities = F.array_distinct(F.transform("base", lambda b: F.concat_ws(":", b["ord"].cast("string"), value(b))))
    terms = F.array_distinct(F.transform(F.filter(_words(_outside(F.col("text"), F.col("base"))), lambda w: F.rlike(w, F.lit(TERM))), F.lower))
    some = F.size("base") > 0
    table = C.materialize(base.select("doc_id", "fp", *(f"n_{k}" for k in KINDS), "base", F.when(some, entities).alias("entities"), F.when(some, terms).alias("terms")), "pii")
    n_t = base.select(F.explode(_distinct_words(base)).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    n_t = C.materialize(n_t, "words")
    frequent, _ = C.listed(n_t, "n_t", most)
    told = disclosing_terms(table.where(some).select("entities", "terms"), n_t, table.count(), frequent, most)
    # words of all documents: those listed that are not told end in the map, what is left is looked up by a join
    listed = frequent.select("term").join(told, "term", "left").select(F.col("term").alias("w"), F.col("disclosure").isNotNull().alias("sure"))
    words = base.select("doc_id", "fp", F.explode(_distinct_words(base)).alias("word")).join(F.broadcast(listed), F.col("word") == F.col("w"), "left")
    found = words.where("w is null or sure").select("doc_id", "fp", "word").join(told, F.col("word") == F.col("term")).select("doc_id", "fp", "term", "disclosure")
    found = C.materialize(found.groupBy("doc_id", "fp").agg(F.collect_set(F.struct("term", "disclosure")).alias("told")), "found")
    # the texts of these documents
    same = lambda a, b: F.col("doc_id").eqNullSafe(F.col(a)) & (F.col("fp") == F.col(b))
    hits = C.among(base.select("doc_id", "fp", _outside(F.col("text"), F.col("base")).alias("masked")), found).where("maybe")
    hits = hits.join(found.select(F.col("doc_id").alias("d"), F.col("fp").alias("f"), "told"), same("d", "f"))
    # the told words as they stand in the text make up a pattern of their own, so that only their places are worked out
    hits = hits.select("doc_id", "fp", "masked", "told", F.col("told.term").alias("names"))
    forms = F.filter(F.array_distinct(_words(F.col("masked"))), lambda w: F.array_contains(F.col("names"), F.lower(w)))
    hits = hits.select("doc_id", "fp", "masked", "told", "names", F.explode(F.array(F.array_join(forms, "|"))).alias("forms")).where("forms <> ''")
    pattern = F.concat(F.lit(r"(?<!\p{L})(?:"), F.col("forms"), F.lit(r")(?!\p{L})"))
    hits = hits.select("doc_id", "fp", "told", "names", F.regexp_extract_all("masked", pattern, F.lit(0)).alias("m"), F.split("masked", pattern, -1).alias("g"))
    rank = lambda x: F.get("told", F.array_position(F.col("names"), F.lower(x["value"])).cast("int") - 1)["disclosure"]
    spot = F.transform(places(F.col("m"), F.col("g")), lambda x: F.struct(x["start"].alias("start"), F.when(rank(x) >= REMOVE, 5).otherwise(4).alias("ord"), x["end"].alias("end"), x["value"].alias("value")))
    spot = hits.select(F.col("doc_id").alias("d"), F.col("fp").alias("f"), spot.alias("terms")).dropDuplicates(["d", "f"])  # rows that repeat a text
    out = table.drop("terms", "entities").join(spot, same("d", "f"), "left")
    out = out.withColumn("terms", F.coalesce("terms", F.array().cast(SPANS)))
    every = F.array_sort(F.concat("base", "terms"))
    names = F.array(*(F.lit(k) for k in (*KINDS, "generalise", "remove")))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda b: F.concat_ws(":", F.element_at(names, b["ord"] + 1), b["start"].cast("string"), b["end"].cast("string"))), ",")

    cols = ["doc_id", *(F.col(f"n_{k}") for k in KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("every")).alias("spans"), F.size("terms").cast("long").alias("n_terms")]
    out = out.withColumn("every", every)
    if not with_text:
        return out.select(*cols)
    out = C.materialize(out.select("doc_id", "fp", *(f"n_{k}" for k in KINDS), "base", "terms", "every"), "spans")
    texts = C.among(base.select("doc_id", "fp", "text"), out.where(F.size("every") > 0)).where("maybe").dropDuplicates(["doc_id", "fp"])
    texts = texts.select(F.col("doc_id").alias("d"), F.col("fp").alias("f"), "text")
    masks = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS), F.lit("[TERM]"), F.lit(""))
    # overlapping spans of different kinds: the first one masks what it covers
    clean = _rebuilt(F.col("text"), F.col("every"), lambda b, s, e: F.when(b["start"] >= s, F.element_at(masks, b["ord"] + 1)).otherwise(F.lit("")))
    return out.join(texts, same("d", "f"), "left").select(*cols, F.when(F.size("every") > 0, clean).alias("sanitised"))


def op6_pii(spark, sf_dir):
    return sanitise(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_text=False)


QUERIES = {"op6_pii": op6_pii}
