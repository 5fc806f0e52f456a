"""Author records: preparation, blocks, pairs, constraints and the 39 pair features, as DataFrames.

A block is a column. Pairs are a self equi-join on it with an order on ids as residual;
features and constraints are projections over joined pairs. Hot blocks are paired whole, in
parts of bounded size; `subblocks` is for plans that want smaller blocks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.storage import materialize

# Fixed values.
AFFIXES = (
    "ab am ap abu al auf aus bar bath bat bet bint dall dalla das de degli del dell della dem den der di do dos ds du el ibn im jr la las le los mac mc mhic mic ter und van vom von zu"
).split()
HIGH, LOW = 10000.0, 0.0
DISALLOW, REQUIRE = 10000.0, 0.0
TILE = 2000  # rows of a block that meet under one join key
AFFILIATION_STOPWORDS = (*T.STOPWORDS, *"university college lab organization department research institute school academy national laboratory".split())
FEATURES = (
    "first_names_equal middle_initials_overlap middle_names_equal middle_one_missing single_char_first single_char_middle affiliation_overlap "
    "email_prefix_equal email_suffix_equal coauthor_overlap coauthor_similarity coauthor_match venue_overlap year_diff title_overlap_words title_overlap_chars "
    "references_authors_overlap references_titles_overlap references_venues_overlap references_author_blocks_overlap references_self_citation references_overlap "
    "position_diff abstract_count english_count same_language language_reliability_count first_name_count_min last_first_name_count_min last_name_count_min "
    "last_first_initial_count_min first_name_count_max last_first_name_count_max embedding_cosine journal_overlap first_name_levenshtein first_name_prefix first_name_lcs first_name_jaro"
).split()
GROUPS = {
    "name_similarity": range(0, 6), "affiliation_similarity": range(6, 7), "email_similarity": range(7, 9), "coauthor_similarity": range(9, 12), "venue_similarity": range(12, 13), "year_diff": range(13, 14), "title_similarity": range(14, 16),
    "reference_features": range(16, 22), "misc_features": range(22, 27), "name_counts": range(27, 33), "embedding_similarity": range(33, 34), "journal_similarity": range(34, 35), "advanced_name_similarity": range(35, 39),
}


def columns_of(groups: list[str]) -> list[str]:
    """Feature columns of the named groups, in feature order."""
    return [FEATURES[i] for i in sorted(i for g in groups for i in GROUPS[g])]


# ---------------------------------------------------------------- preparation
def prepare_papers(papers: DataFrame) -> DataFrame:
    """papers (paper_id, title, abstract, journal_name, venue, year, authors, references) plus normalised text and gram multisets."""
    has = lambda c: F.coalesce(F.length(F.trim(F.col(c))) > 0, F.lit(False))
    title, venue, journal = (T.normalize_text(F.col(c)) for c in ("title", "venue", "journal_name"))
    return papers.select(
        "*", title.alias("title_n"), has("abstract").alias("has_abstract"),
        T.occurrences(T.word_ngrams(title)).alias("title_words"), T.occurrences(T.char_ngrams(title)).alias("title_chars"),
        T.occurrences(T.char_ngrams(venue, stopwords=T.VENUE_STOPWORDS)).alias("venue_grams"), T.occurrences(T.char_ngrams(journal, stopwords=T.VENUE_STOPWORDS)).alias("journal_grams"),
    )


def reference_details(papers: DataFrame) -> DataFrame:
    """(paper_id, ref_authors, ref_titles, ref_venues, ref_blocks): gram multisets over the resolved references; misses drop out."""
    refs = papers.select("paper_id", F.explode("references").alias("ref"))
    cited = papers.select(F.col("paper_id").alias("ref"), T.normalize_text(F.col("title")).alias("title"), T.normalize_text(F.concat_ws(" ", "venue", "journal_name")).alias("venue"), F.transform("authors", lambda a: T.normalize_text(a["author_name"])).alias("names"))
    both = refs.join(cited, "ref").groupBy("paper_id").agg(
        F.concat_ws(" ", F.array_sort(F.collect_list(F.array_join("names", " ")))).alias("names"), F.concat_ws(" ", F.array_sort(F.collect_list("title"))).alias("titles"),
        F.concat_ws(" ", F.array_sort(F.collect_list("venue"))).alias("venues"), F.flatten(F.collect_list(F.transform("names", T.compute_block))).alias("blocks"),
    )
    return both.select("paper_id", T.occurrences(T.char_ngrams(F.col("names"), stopwords=None)).alias("ref_authors"), T.occurrences(T.word_ngrams(F.col("titles"))).alias("ref_titles"), T.occurrences(T.char_ngrams(F.col("venues"), stopwords=T.VENUE_STOPWORDS)).alias("ref_venues"), T.occurrences(F.col("blocks")).alias("ref_blocks"))


def prepare_signatures(signatures: DataFrame, papers: DataFrame, name_counts: dict[str, DataFrame] | None = None) -> DataFrame:
    """signatures (signature_id, paper_id, first, middle, last, suffix, position, email, affiliations, source_ids)
    with normalised names, block, coauthors (other positions of the paper), ORCID and name counts (1 where unknown)."""
    name = T.split_first_middle(F.col("first"), F.col("middle"))
    s = signatures.withColumn("name", name).withColumn("first_n", F.col("name.first")).withColumn("middle_n", F.col("name.middle")).drop("name").withColumn("last_n", T.normalize_text(F.col("last")))
    s = s.withColumn("block", T.compute_block(F.trim(F.concat_ws(" ", "first_n", "last_n")))).withColumn("orcid", T.orcid(F.col("source_ids")))
    s = s.withColumn("affiliation_grams", T.occurrences(T.word_ngrams(T.normalize_text(F.array_join("affiliations", " ")), AFFILIATION_STOPWORDS)))
    s = s.join(papers.select("paper_id", "authors"), "paper_id")
    others = F.transform(F.filter("authors", lambda a: a["position"] != F.col("position")), lambda a: T.normalize_text(a["author_name"]))
    s = s.withColumn("coauthors", F.array_sort(F.array_distinct(others))).withColumn("coauthor_blocks", F.array_sort(F.array_distinct(F.transform("coauthors", T.compute_block))))
    s = s.withColumn("coauthor_grams", T.occurrences(T.char_ngrams(F.array_join("coauthors", " "), unigrams=False, stopwords=None))).drop("authors")
    canonical = F.when(F.contains(F.coalesce("last", F.lit("")), F.lit("-")) | F.contains(F.col("last_n"), F.lit(" ")), F.replace("last_n", F.lit(" "), F.lit(""))).otherwise(F.col("last_n"))
    head = F.split("first_n", " ")[0]
    keys = {"first": head, "last": canonical, "first_last": F.concat_ws(" ", head, canonical), "last_first_initial": F.concat_ws(" ", canonical, head)}
    for kind, key in keys.items():
        if name_counts is None:
            s = s.withColumn(f"count_{kind}", F.lit(None).cast("double"))
        else:
            table = name_counts[kind].select(F.col("name").alias("_k"), F.col("n").cast("double").alias(f"count_{kind}"))
            s = s.withColumn("_key", key).join(table, F.col("_key") == F.col("_k"), "left").drop("_k", "_key").withColumn(f"count_{kind}", F.coalesce(f"count_{kind}", F.lit(1.0)))
    return s


def sided(df: DataFrame, side: str) -> DataFrame:
    return df.select(*(F.col(c).alias(f"{c}_{side}") for c in df.columns))


# ---------------------------------------------------------------- blocks and pairs
def subblocks(names: DataFrame, maximum: int, start: int = 2) -> DataFrame:
    """(id, name, subblock): each id under the shortest prefix, from `start` letters on, that at most
    `maximum` ids share; ids whose whole name is shared by more are dealt by hash into numbered parts."""
    # all ids under a prefix share its shorter ones, so counts of all prefixes, taken at once, tell the shortest small one
    each = names.groupBy("name").agg(F.count("*").alias("c")).select("name", "c", F.explode(F.sequence(F.lit(start), F.greatest(F.lit(start), F.length("name") + 1))).alias("k"))
    each = each.withColumn("p", F.left("name", F.col("k")))
    small = each.groupBy("k", "p").agg(F.sum("c").alias("t")).where(F.col("t") <= maximum)
    best = each.join(small, ["k", "p"]).groupBy("name").agg(F.min(F.struct("k", "p")).alias("x")).select(F.col("name").alias("nm"), F.col("x.p").alias("subblock"))
    out = names.select("id", "name").join(best, F.col("name") == F.col("nm"), "left").drop("nm")
    rest = out.where("subblock is null").groupBy("name").agg(F.ceil(F.count("*") / maximum).alias("parts")).select(F.col("name").alias("m"), "parts")
    part = F.concat(F.col("name"), F.lit("#"), F.pmod(F.xxhash64("id"), F.col("parts")).cast("string"))
    return out.join(rest, F.col("name") == F.col("m"), "left").select("id", "name", F.coalesce("subblock", part).alias("subblock"))


def bounded_blocks(rows: DataFrame, maximum: int) -> DataFrame:
    """(id, part): rows (block, id, first) of blocks of at most `maximum` rows under their block, those of larger ones under
    block|subblock=..., by the shortest prefix of the first name that few enough share. Single letters make up parts of their own."""
    sizes = rows.groupBy(F.col("block").alias("_b")).agg(F.count("*").alias("_n")).where(F.col("_n") > maximum)
    large = rows.join(sizes, F.col("block") == F.col("_b"))
    mark = F.lit("|subblock=")
    # the block counts as the beginning of the name; it is the same within a block, so prefixes that end in it are blocks
    head = F.concat(F.col("block"), mark)
    each = large.select("id", head.alias("head"), F.coalesce("first", F.lit("")).alias("first"))
    names = each.select("id", "head", "first", F.concat("head", "first", F.lit("\n")).alias("name"))
    count = names.groupBy("name", "head").agg(F.count("*").alias("c"))
    size = F.length("head")
    ends = F.sequence(size + 1, F.greatest(F.length("name"), size + 2))
    pre = count.select("name", "c", "head", F.explode(ends).alias("k")).withColumn("p", F.left("name", F.col("k")))
    # a name of one letter ends right behind it, and longer ones begin to count from two letters on
    pre = pre.where((F.col("k") > size + 1) | (F.length("name") <= size + 1))
    small = pre.groupBy("k", "p").agg(F.sum("c").alias("t")).where(F.col("t") <= maximum)
    best = pre.join(small, ["k", "p"]).groupBy("name").agg(F.min(F.struct("k", "p")).alias("x")).select(F.col("name").alias("_m"), F.col("x.p").alias("_part"))
    out = names.join(best, F.col("name") == F.col("_m"), "left")
    rest = out.where("_part is null").groupBy("name").agg(F.ceil(F.count("*") / maximum).alias("_parts")).select(F.col("name").alias("_r"), "_parts")
    # what is left is dealt by rank and not by hash, so that no part is larger than allowed
    rank = F.row_number().over(Window.partitionBy("name").orderBy("id")) - 1
    dealt = out.where("_part is null").select("id", "name", rank.alias("_i")).join(rest, F.col("name") == F.col("_r"))
    dealt = dealt.select("id", F.concat("name", F.lit("#"), (F.col("_i") % F.col("_parts")).cast("string")).alias("part"))
    trim = lambda c: F.regexp_replace(c, "\n", "")
    large_parts = out.where("_part is not null").select("id", trim("_part").alias("part")).unionByName(dealt.select("id", trim("part").alias("part")))
    others = rows.join(sizes, F.col("block") == F.col("_b"), "left_anti").select("id", F.col("block").alias("part"))
    return others.unionByName(large_parts)


def pairs_in_block(rows: DataFrame, block: str, key: str, tile: int = TILE) -> DataFrame:
    """All unordered pairs (a < b) of the rows of a block, with both sides' columns.

    Blocks of more than `tile` rows are dealt by hash into parts of about that size; each part meets each
    part under a join key of its own, so that no task has a whole hot block's pairs."""
    # one row for each hot block, at most one for each `tile` rows
    hot = rows.groupBy(F.col(block).alias("_hot")).agg(F.count("*").alias("_n")).where(F.col("_n") > tile).select("_hot", F.ceil(F.col("_n") / tile).cast("int").alias("_parts"))
    dealt = rows.join(F.broadcast(hot), F.col(block) == F.col("_hot"), "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    dealt = dealt.withColumn("_part", F.pmod(F.xxhash64(key), F.col("_parts")).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    # dealt out by number, as few bytes make many pairs and small partitions would be put together
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.select(*rows.columns, "_part", "_other")
    a, b = (sided(dealt.repartition(n, block, *parts), side) for side, parts in (("a", ("_part", "_other")), ("b", ("_other", "_part"))))
    same = (F.col(f"{block}_a") == F.col(f"{block}_b")) & (F.col("_part_a") == F.col("_other_b")) & (F.col("_other_a") == F.col("_part_b"))
    return a.join(b, same & (F.col(f"{key}_a") < F.col(f"{key}_b"))).drop("_part_a", "_other_a", "_part_b", "_other_b")


def drop_singletons(rows: DataFrame, block: str, first: int | None = None) -> DataFrame:
    """Rows of blocks with two rows or more; of these, the first blocks in order of their key."""
    sizes = rows.groupBy(block).agg(F.count("*").alias("_n")).where("_n > 1")
    if first is not None:
        sizes = sizes.orderBy(block).limit(first)
    return rows.join(sizes.select(F.col(block).alias("_b")), F.col(block) == F.col("_b"), "left_semi")


def pair_category(name_a: Column, name_b: Column, cluster_a: Column, cluster_b: Column) -> Column:
    same_name, same_cluster = name_a == name_b, cluster_a == cluster_b
    return F.concat(F.when(same_name, "same").otherwise("different"), F.lit("_name_"), F.when(same_cluster, "same").otherwise("different"), F.lit("_cluster"))


def hash_order(seed: int, *keys: str) -> Column:
    """A seeded order that any engine with MD5 can repeat."""
    return F.md5(F.concat_ws("_", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))


def balanced_sample(pairs: DataFrame, category: str, n: int, seed: int, *keys: str, sizes: dict[str, int] | None = None, small_pairs: Callable[[dict[str, float]], DataFrame] | None = None) -> DataFrame:
    """At most ceil(n / categories) pairs of each category (categories: 4 for names and clusters, 2 for labels), in hash order.

    One pass: a task sends the first ceil(n / 2) of each category at most, and what is left of these tells how many there are.
    sizes: the number of pairs of each category, where it is known; then only pairs with small enough hashes, some 8 times as many
    as wanted and 400, are sorted. Should they not be enough, all are. small_pairs: what gives, for shares of categories, some of
    the pairs, all those among them whose hashes are within these shares; then `pairs` are only made if all are sorted."""
    most = -(-n // 2)
    if sizes is not None:
        share = {c: (8 * most + 400) / size for c, size in sizes.items() if size > 8 * most + 400}
        small = F.lit(True)
        for c, x in share.items():
            small = small & ((F.col(category) != c) | (hash_order(seed, *keys) < format(int(x * 2**64), "016x")))
        few = materialize((small_pairs(share) if small_pairs else pairs).where(small), "sample")
        held = {r[0]: r[1] for r in few.groupBy(category).count().collect()}
        if set(held) == set(sizes) and all(held[c] >= min(most, size) for c, size in sizes.items()):
            pairs = few
    ranked = pairs.withColumn("_r", F.row_number().over(Window.partitionBy(category).orderBy(hash_order(seed, *keys), *keys))).where(F.col("_r") <= most)
    kinds = F.size(F.collect_set(category).over(Window.partitionBy(F.lit(1))))  # over a few times n rows
    some = F.when(kinds > 2, -(-n // 4)).otherwise(most)
    return ranked.withColumn("_n", some).where(F.col("_r") <= F.col("_n")).select(*pairs.columns)


def balanced_pairs(rows: DataFrame, block: str, key: str, name: str, cluster: str, n: int, seed: int) -> DataFrame:
    """(a, b, category): `balanced_sample` of all pairs of the rows of a block by names (or whole numbers) and clusters. Categories are
    counted without pairs, and pairs are hashed in arrays; only those with small hashes become rows."""
    from millrace.operators.pair_counts import category_counts
    from millrace.operators.pair_hashes import small_pairs

    rows = rows.select(block, key, name, cluster)
    category = pair_category(F.col(f"{name}_a"), F.col(f"{name}_b"), F.col(f"{cluster}_a"), F.col(f"{cluster}_b"))
    pairs = pairs_in_block(rows, block, key).select(F.col(f"{key}_a").alias("a"), F.col(f"{key}_b").alias("b"), category.alias("category"))
    sizes = {r["category"]: r["n"] for r in category_counts(rows, block, key, name, cluster).collect()}  # four at most
    return balanced_sample(pairs, "category", n, seed, "a", "b", sizes=sizes, small_pairs=lambda share: small_pairs(rows, block, key, name, cluster, seed, share))


def random_sample(rows: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    return rows.orderBy(hash_order(seed, *keys), *keys).limit(n)


def label_map(label: Column) -> Column:
    """YES, NO and digits to 1 and 0."""
    text = F.upper(F.trim(label.cast("string")))
    return F.when(text.isin("YES", "1", "1.0"), 1).when(text.isin("NO", "0", "0.0"), 0)


# ---------------------------------------------------------------- splits
def time_split(rows: DataFrame, key: str, year: str, train: float, val: float) -> DataFrame:
    """rows plus `split` by year (missing as 0), ties by key.

    Ranks come from counts per year (a short table) and a window within a year, so no window runs over all rows."""
    y = F.coalesce(F.col(year), F.lit(0))
    rows = rows.withColumn("_y", y)
    per_year = rows.groupBy("_y").agg(F.count("*").alias("_c"))
    before = Window.orderBy("_y").rowsBetween(Window.unboundedPreceding, -1)  # one row per year
    starts = per_year.select("_y", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_s")).crossJoin(per_year.agg(F.sum("_c").alias("_t")))
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy("_y").orderBy(key))).join(F.broadcast(starts), "_y")
    at = F.col("_s") + F.col("_r")
    cut = lambda share: F.floor(F.col("_t") * F.lit(share))
    return ranked.withColumn("split", F.when(at <= cut(train), "train").when(at <= cut(train) + cut(val), "val").otherwise("test")).drop("_y", "_s", "_t", "_r")


def hash_split(rows: DataFrame, unit: str, train: float, val: float, seed: int) -> DataFrame:
    """rows plus `split`: all rows of a unit (a block or a signature) together, by a seeded hash."""
    share = F.conv(F.substring(hash_order(seed, unit), 1, 8), 16, 10).cast("double") / float(16**8)
    return rows.withColumn("split", F.when(share < train, "train").when(share < train + val, "val").otherwise("test"))


def fixed_split(rows: DataFrame, unit: str, train: DataFrame, val: DataFrame | None, test: DataFrame) -> DataFrame:
    """rows plus `split` from lists of units (column `unit`); rows of no list drop out."""
    import functools

    lists = functools.reduce(DataFrame.unionByName, [d.select(F.col("unit").alias("_u"), F.lit(n).alias("split")) for n, d in (("train", train), ("val", val), ("test", test)) if d is not None])
    return rows.join(lists, F.col(unit) == F.col("_u")).drop("_u")


# ---------------------------------------------------------------- constraints
def constraint(alias_hit: Column, dont_merge_seeds: bool = True, incremental: bool = False) -> Column:
    """Distance that rules impose on a pair (columns of both sides with _a and _b), NULL for none; the first rule that holds decides.

    Sides: first_n, middle_n, last_n, orcid, seed (cluster of a required seed or NULL), reliable, language; the pair: disallowed."""
    c = lambda name, side: F.col(f"{name}_{side}")
    same_seed = F.coalesce(c("seed", "a") == c("seed", "b"), F.lit(False)) & F.lit(not incremental)
    cross_seed = F.coalesce(c("seed", "a") != c("seed", "b"), F.lit(False)) & F.lit(dont_merge_seeds)
    initials = (F.length(c("first_n", "a")) > 0) & (F.length(c("first_n", "b")) > 0) & (F.left(c("first_n", "a"), F.lit(1)) != F.left(c("first_n", "b"), F.lit(1)))
    languages = c("reliable", "a") & c("reliable", "b") & (c("language", "a") != c("language", "b"))
    ma, mb = T.words(c("middle_n", "a")), T.words(c("middle_n", "b"))
    shared = F.array_intersect(F.array_intersect(ma, mb), F.array(*(F.lit(x) for x in AFFIXES)))
    rest = lambda m: F.filter(m, lambda w: ~F.array_contains(shared, w))
    ra, rb = rest(ma), rest(mb)
    heads = lambda m: F.transform(m, lambda w: F.left(w, F.lit(1)))
    long = lambda m: F.filter(m, lambda w: F.length(w) > 1)
    letters = lambda m: F.array_sort(F.array_distinct(F.split(F.array_join(m, ""), "")))
    other_initials = (F.size(ra) > 0) & (F.size(rb) > 0) & ~F.arrays_overlap(heads(ra), heads(rb))
    other_words = (F.size(long(ra)) > 0) & (F.size(long(rb)) > 0) & ~F.arrays_overlap(long(ra), long(rb)) & (letters(long(ra)) != letters(long(rb)))
    return (
        F.when(F.col("disallowed"), DISALLOW)
        .when(same_seed, REQUIRE)
        .when(cross_seed, DISALLOW)
        .when(F.coalesce(c("orcid", "a") == c("orcid", "b"), F.lit(False)), LOW)
        .when(~T.lasts_equivalent(c("last_n", "a"), c("last_n", "b")), HIGH)
        .when(initials, HIGH)
        .when(F.coalesce(languages, F.lit(False)), HIGH)
        .when(~T.same_prefix_tokens(c("first_n", "a"), c("first_n", "b")) & ~alias_hit, HIGH)
        .when((F.size(ma) > 0) & (F.size(mb) > 0) & (other_initials | other_words), HIGH)
    )


def with_aliases(pairs: DataFrame, aliases: DataFrame) -> DataFrame:
    """pairs plus `alias_hit`: whether (whole, joined or first-word) first names are known aliases, either way round."""
    known = aliases.select(F.explode(F.array(F.concat_ws("\t", "name_a", "name_b"), F.concat_ws("\t", "name_b", "name_a"))).alias("_k")).distinct()
    forms = (lambda x: x, lambda x: F.replace(x, F.lit(" "), F.lit("")), lambda x: F.split(x, " ")[0])
    hit = F.lit(False)
    for i, form in enumerate(forms):
        pairs = pairs.join(known.withColumnRenamed("_k", f"_k{i}"), F.concat_ws("\t", form(F.col("first_n_a")), form(F.col("first_n_b"))) == F.col(f"_k{i}"), "left")
        hit = hit | F.col(f"_k{i}").isNotNull()
    return pairs.withColumn("alias_hit", hit).drop("_k0", "_k1", "_k2")


# ---------------------------------------------------------------- features
def pair_features(references: bool = False) -> list[Column]:
    """The 39 feature columns over pairs of prepared signatures with their papers' columns, each side with _a and _b."""
    a, b = (lambda n: F.col(f"{n}_a")), (lambda n: F.col(f"{n}_b"))
    both = lambda f, n, *x: f(a(n), b(n), *x)
    initials = lambda m: T.occurrences(F.transform(T.words(m), lambda w: F.left(w, F.lit(1))))
    single = lambda m: F.exists(F.split(m, " "), lambda w: F.length(w) == 1)
    empty = lambda m: F.length(m) == 0
    year = lambda c: F.when(c > 0, c)
    ea, eb = T.email_parts(a("email")), T.email_parts(b("email"))
    english = a("language").isin("en", "un").cast("int") + b("language").isin("en", "un").cast("int")
    nonzero = lambda v: F.exists(v, lambda x: x != 0)
    least = lambda n: F.least(a(n), b(n))  # noqa: E731  skips NULL
    most = lambda n: F.when(a(n).isNotNull() & b(n).isNotNull(), F.greatest(a(n), b(n)))
    if references:
        cites = F.array_contains(a("references"), b("paper_id")) | F.array_contains(b("references"), a("paper_id"))
        refs = [both(T.multiset_jaccard, "ref_authors", 5000), both(T.multiset_jaccard, "ref_titles"), both(T.multiset_jaccard, "ref_venues"), both(T.multiset_jaccard, "ref_blocks"), F.coalesce(cites, F.lit(False)).cast("int"), both(T.jaccard, "references")]
    else:
        refs = [F.lit(None).cast("double")] * 6
    values = [
        both(T.equal, "first_n"), T.multiset_jaccard(initials(a("middle_n")), initials(b("middle_n"))), both(T.equal_middle, "middle_n"), (empty(a("middle_n")) != empty(b("middle_n"))).cast("int"),
        ((F.length(a("first_n")) == 1) | (F.length(b("first_n")) == 1)).cast("int"), (single(a("middle_n")) | single(b("middle_n"))).cast("int"), both(T.multiset_jaccard, "affiliation_grams"),
        (ea["prefix"] == eb["prefix"]).cast("int"), (ea["suffix"] == eb["suffix"]).cast("int"),
        both(T.jaccard, "coauthor_blocks"), both(T.multiset_jaccard, "coauthor_grams", 5000), both(T.jaccard, "coauthors"),
        both(T.multiset_jaccard, "venue_grams"), T.difference(year(a("year")), year(b("year")), 50), both(T.multiset_jaccard, "title_words"), both(T.multiset_jaccard, "title_chars"), *refs,
        both(T.difference, "position", 50), a("has_abstract").cast("int") + b("has_abstract").cast("int"), english, (a("language") == b("language")).cast("int"), a("reliable").cast("int") + b("reliable").cast("int"),
        least("count_first"), least("count_first_last"), least("count_last"), least("count_last_first_initial"), most("count_first"), most("count_first_last"),
        F.when((english == 2) & nonzero(a("vector")) & nonzero(b("vector")), both(T.cosine, "vector") + 1), both(T.multiset_jaccard, "journal_grams"), *T.name_text_features(a("first_n"), b("first_n")),
    ]
    return [v.cast("double").alias(n) for v, n in zip(values, FEATURES)]


def featurize(signatures: DataFrame, papers: DataFrame, key: str = "signature_id", references: bool = False, groups: list[str] | None = None, block: str = "block") -> DataFrame:
    """(a, b, features...) for all pairs in a block (or sub-block) of prepared signatures; values as of `pair_features`."""
    from millrace.operators.pair_tiles import pair_table

    rows = signatures.join(papers.drop("authors"), "paper_id")
    out = pair_table(rows, block, key, FEATURES, references)
    return out if groups is None else out.select("a", "b", *columns_of(groups))


def flip_gate(names: DataFrame, ratio: float = 2.0) -> DataFrame:
    """names (paper_id, position, name, flipped): names whose order is to be turned.

    Per name, papers with several authors (x turned, y not) decide by x >= ratio * y where there are any, else turns (a) among single authors do."""
    multi = names.groupBy("paper_id").agg(F.countDistinct("position").alias("_n")).select("paper_id", (F.col("_n") > 1).alias("multi"))
    stat = names.join(multi, "paper_id").groupBy("name").agg(
        F.count_if(~F.col("multi") & F.col("flipped")).alias("a"), F.count_if(~F.col("multi") & ~F.col("flipped")).alias("b"), F.count_if(F.col("multi") & F.col("flipped")).alias("x"), F.count_if(F.col("multi") & ~F.col("flipped")).alias("y")
    )
    return stat.withColumn("turn", F.when(F.col("x") + F.col("y") > 0, F.col("x") >= ratio * F.col("y")).otherwise(F.col("a") > 0))


def split_pairs(pairs: DataFrame, splits: DataFrame) -> DataFrame:
    """pairs (a, b, ...) plus `split` where both ids lie in one; splits: (id, split). Pairs across splits drop out."""
    a = splits.select(F.col("id").alias("_a"), F.col("split").alias("_sa"))
    b = splits.select(F.col("id").alias("_b"), F.col("split").alias("_sb"))
    both = pairs.join(a, F.col("a") == F.col("_a")).join(b, F.col("b") == F.col("_b"))
    return both.where(F.col("_sa") == F.col("_sb")).select(*pairs.columns, F.col("_sa").alias("split"))


def sample_pairs(rows: DataFrame, block: str, key: str, name: str, cluster: str, n: int, seed: int, balanced: bool = True, within: bool = True) -> DataFrame:
    """(a, b, label, category): pairs of a block, or of all rows, by hash order; balanced: as many of each kind of name and cluster."""
    rows = rows if within else rows.withColumn("_all", F.lit("all"))
    pairs = pairs_in_block(rows, block if within else "_all", key)
    category = pair_category(F.col(f"{name}_a"), F.col(f"{name}_b"), F.col(f"{cluster}_a"), F.col(f"{cluster}_b"))
    label = (F.col(f"{cluster}_a") == F.col(f"{cluster}_b")).cast("int")
    pairs = pairs.select(F.col(f"{key}_a").alias("a"), F.col(f"{key}_b").alias("b"), label.alias("label"), category.alias("category"))
    return balanced_sample(pairs, "category", n, seed, "a", "b") if balanced else random_sample(pairs, n, seed, "a", "b")
