"""Document fingerprints: SimHash with permuted block tables, in DataFrame operations only.

A text's terms are its words with the word that follows, each once however often it is repeated; a term's
weight is its length, up to a bound. Each term's hash votes with its weight on every bit, and a bit is set when it wins more than half of
all weight. Two bits are counted in one 64-bit sum, so a bit costs half an addition.

Near fingerprints: bits are cut into radius + 1 blocks. Two fingerprints within the radius agree in one
block at least, so one table per block, keyed by it, holds every such pair under an equal key. Equal
fingerprints are one entry in the tables, so a group of copies is no hot key. Fingerprints of one key meet
as an array; a key of many is cut in blocks and every two blocks meet in an array of their own. A meeting
hands on counts and a spanning forest, never pairs.

A null or empty text, or one without words, has the fingerprint of no votes (all bits clear). Equal texts
have equal fingerprints. Rows with equal ids stand in the order of their texts; null ids come last.
Only the two named columns are read. An empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqlog.llm.common import GAP, min_labels, table, written

#: 64-bit words of a fingerprint.
WORDS = 2
#: Largest weight of a term, else its number of letters; one less than a power of two.
MAX_WEIGHT = 15
#: Hamming radius of near fingerprints.
RADIUS = 3
#: Distinct fingerprints of a block key that are compared with each other in one array.
KEY_BLOCK = 128
LANES = (1 << 32) + 1
LOWEST = -(1 << 63)


def _terms(text: Column) -> Column:
    """The text's distinct terms: a hash each, with the weight in its lowest four bits."""
    words = F.filter(F.split(text, GAP), lambda w: w != "")
    following = F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1)))

    def term(word: Column, follower: Column) -> Column:
        follower = F.coalesce(follower, F.lit(""))
        weight = F.least(F.length(word) + F.length(follower), F.lit(MAX_WEIGHT))
        return F.xxhash64(word, follower).bitwiseAND(F.lit(~MAX_WEIGHT)).bitwiseOR(weight)

    return F.array_distinct(F.zip_with(words, following, term))


def _votes(hash_: Column, weight: Column) -> list[Column]:
    return [F.sum(weight * F.shiftright(hash_, i).bitwiseAND(F.lit(LANES))) for i in range(32)]


def _bits(sums: list[str], total: str) -> Column:
    """One 64-bit word of the fingerprint from its 32 double sums."""
    word = F.lit(0).cast("long")
    for i, name in enumerate(sums):
        low, high = F.col(name).bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(F.col(name), 32)
        for bit, votes in ((i, low), (i + 32, high)):
            one = F.lit((1 << bit) - (1 << 64 if bit == 63 else 0)).cast("long")
            word = word.bitwiseOR(F.when(votes * 2 > F.col(total), one).otherwise(F.lit(0).cast("long")))
    return word


def fingerprint_rows(texts: DataFrame, keys: list[str], text_col: str, words: int = WORDS) -> DataFrame:
    """`keys` (which must name a row) and fp0, fp1, ...: SimHash of `text_col`."""
    term = texts.select(*keys, F.explode_outer(_terms(F.coalesce(text_col, F.lit("")))).alias("_t"))
    weight = F.coalesce(F.col("_t").bitwiseAND(F.lit(MAX_WEIGHT)), F.lit(0)).cast("long")
    hashes = [F.xxhash64(F.lit(k), "_t").alias(f"_h{k}") for k in range(words)]
    hashed = term.select(*keys, weight.alias("_w"), *hashes)
    votes = [
        v.alias(f"_v{k}_{i}")
        for k in range(words)
        for i, v in enumerate(_votes(F.col(f"_h{k}"), F.col("_w")))
    ]
    summed = hashed.groupBy(*keys).agg(F.sum("_w").alias("_total"), *votes)
    fps = [_bits([f"_v{k}_{i}" for i in range(32)], "_total").alias(f"fp{k}") for k in range(words)]
    return summed.select(*keys, *fps)


def distance(one: list[Column], other: list[Column]) -> Column:
    return sum((F.bit_count(a.bitwiseXOR(b)) for a, b in zip(one, other, strict=True)), F.lit(0))


def hexadecimal(words: list[Column]) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(w), 16, "0") for w in words]))


def near_pairs(fingerprints: DataFrame, radius: int = RADIUS, words: int = WORDS) -> DataFrame:
    """Every pair of different fingerprints within `radius` (fp0.., near0.., the smaller first), once."""
    tables = _block_tables(fingerprints, radius, words)
    mine = [f"fp{k}" for k in range(words)]
    other = tables.select("block", "key", *[F.col(c).alias(f"near{k}") for k, c in enumerate(mine)])
    ordered = F.struct(*mine) < F.struct(*[f"near{k}" for k in range(words)])
    close = distance([F.col(c) for c in mine], [F.col(f"near{k}") for k in range(words)]) <= radius
    both = tables.join(other, ["block", "key"]).where(ordered & close)
    return both.select(*mine, *[f"near{k}" for k in range(words)]).distinct()


def _places(radius: int, words: int) -> list[tuple[int, int, int]]:
    """Word, first bit and width of every block."""
    width = -(-64 * words // (radius + 1))
    if 64 % width and width % 64:
        raise ValueError("blocks must not straddle two words of a fingerprint")
    return [(start // 64, start % 64, width) for start in range(0, 64 * words, width)]


def _block(word: Column, start: int, width: int) -> Column:
    value = F.shiftrightunsigned(word, start)
    return value if width >= 64 else value.bitwiseAND(F.lit((1 << width) - 1))


def _blocks(distinct: DataFrame, radius: int, words: int) -> DataFrame:
    """Every row once per block, with `block` and `key`."""
    keys = [_block(F.col(f"fp{word}"), start, width) for word, start, width in _places(radius, words)]
    return distinct.select(F.posexplode(F.array(*keys)).alias("block", "key"), *distinct.columns)


def _block_tables(fingerprints: DataFrame, radius: int, words: int) -> DataFrame:
    """One row per distinct fingerprint and block: (block, key, fp0, ...)."""
    return _blocks(fingerprints.select(*[f"fp{k}" for k in range(words)]).distinct(), radius, words)


def _meetings(prints: DataFrame, radius: int, words: int) -> DataFrame:
    """`node`, `others` (rows of near fingerprints) and `low` (a node it is linked to), per meeting.

    `prints`: distinct fingerprints with `node`, a number each, and `n`, their rows. A pair counts where
    its first equal block meets, so over all meetings it counts once.
    """
    columns, places = [f"fp{k}" for k in range(words)], _places(radius, words)
    tables = _blocks(prints.select("node", "n", *columns), radius, words)
    large = tables.groupBy("block", "key").agg(F.ceil(F.count("*") / KEY_BLOCK).cast("int").alias("_n"))
    cut = tables.join(large.where("_n > 1"), ["block", "key"], "left").withColumn("_n", F.coalesce("_n", F.lit(1)))
    met = (
        cut.withColumn("_mine", F.pmod(F.xxhash64("node"), F.col("_n")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
        .groupBy("block", "key", F.least("_mine", "_other").alias("_x"), F.greatest("_mine", "_other").alias("_y"))
        .agg(F.collect_list(F.struct("node", "n", *columns, "_mine")).alias("_all"))
        .where(F.size("_all") > 1)
    )

    def near(a: Column, b: Column) -> Column:
        close = distance([a[c] for c in columns], [b[c] for c in columns]).between(1, radius)
        close &= (F.col("_x") == F.col("_y")) | (a["_mine"] != b["_mine"])
        for k, (word, start, width) in enumerate(places[:-1]):
            differs = a[f"fp{word}"].bitwiseXOR(b[f"fp{word}"])
            close &= (F.col("block") <= k) | (_block(differs, start, width) != 0)
        return close

    def linked(labels: Column, i: Column) -> Column:
        one = F.element_at("_all", i)
        both = F.zip_with("_all", labels, lambda e, label: F.struct(e.alias("e"), label.alias("label")))
        touched = F.filter(both, lambda p: near(one, p["e"]) | (p["e"]["node"] == one["node"]))
        merged = lambda t: F.transform(
            labels, lambda label: F.when(F.array_contains(t, label), F.array_min(t)).otherwise(label)
        )
        # An array of one entry binds what was touched, so that it is found once.
        bound = F.array(F.array_distinct(F.transform(touched, lambda p: p["label"])))
        return F.element_at(F.transform(bound, lambda t: F.when(F.size(t) > 1, merged(t)).otherwise(labels)), 1)

    others = F.transform(
        "_all",
        lambda a: F.aggregate(
            F.filter("_all", lambda b: near(a, b)), F.lit(0).cast("long"), lambda total, b: total + b["n"]
        ),
    )
    labels = F.aggregate(
        F.sequence(F.lit(1), F.size("_all")), F.transform("_all", lambda e: e["node"]), linked
    )
    counted = F.zip_with("_all", others, lambda e, total: F.struct(e["node"].alias("node"), total.alias("others")))
    found = F.zip_with(
        counted,
        labels,
        lambda c, low: F.struct(c["node"].alias("node"), c["others"].alias("others"), low.alias("low")),
    )
    return met.select(F.explode(found).alias("_f")).select("_f.*").where("others > 0")


def near_classes(
    fingerprints: DataFrame, radius: int = RADIUS, words: int = WORDS, id_col: str = "doc_id"
) -> DataFrame:
    """fp0, ..., near_class and n_links of every fingerprint that another row has or is near to.

    `n_links`: the other rows of equal fingerprint and all rows of near ones. `near_class`: the smallest id
    that chains of near fingerprints reach; null where no row of them has an id.
    """
    columns = [f"fp{k}" for k in range(words)]
    rows = fingerprints.groupBy(*columns).agg(F.min(id_col).alias("rep"), F.count("*").alias("n"))
    prints, _ = written(rows.withColumn("node", F.monotonically_increasing_id()), "prints")
    links, _ = written(_meetings(prints, radius, words), "near-prints")
    counts = links.groupBy("node").agg(F.sum("others").alias("others"))
    labels = min_labels(links.where("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b")))
    labelled = labels.withColumnRenamed("id", "node").join(prints.select("node", "rep"), "node")
    classes = labelled.groupBy("label").agg(F.min("rep").alias("near_class"))
    reached = labelled.select("node", "label").join(classes, "label").select("node", "near_class")
    return (
        prints.join(counts, "node", "left")
        .join(reached, "node", "left")
        .select(
            *columns,
            F.coalesce("near_class", "rep").alias("near_class"),
            (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        )
        .where("n_links > 0")
    )


def with_near(fingerprints: DataFrame, radius: int = RADIUS, words: int = WORDS) -> DataFrame:
    """Distinct fingerprints that have another one within `radius`; pairs are not listed."""
    columns = [f"fp{k}" for k in range(words)]
    tables = _block_tables(fingerprints, radius, words).alias("a")
    other = tables.alias("b")
    apart = distance([F.col(f"a.{c}") for c in columns], [F.col(f"b.{c}") for c in columns])
    met = (F.col("a.block") == F.col("b.block")) & (F.col("a.key") == F.col("b.key"))
    return tables.join(other, met & apart.between(1, radius), "left_semi").select(*columns).distinct()


def _bucketed(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows in ranges of descending ids (`_range`), plus each range's first row again at the end of the
    range before it (`_extra`), so that a row and its successor stand in the same range."""
    probabilities = [i / buckets for i in range(1, buckets)]
    bounds = sorted(set(docs.agg(F.percentile_approx("_order", probabilities, 10_000)).first()[0] or [])) if probabilities else []
    steps = [1 << b for b in reversed(range(max(1, len(bounds).bit_length())))]
    place = F.lit(0)
    if bounds:
        sorted_bounds = F.array(*[F.lit(int(b)).cast("long") for b in bounds])
        n = len(bounds)
        # Binary search: how many bounds are not above the id.
        place = F.aggregate(
            F.array(*map(F.lit, steps)),
            F.lit(0),
            lambda at, step: F.when(
                (at + step <= n)
                & (F.element_at(sorted_bounds, F.least(at + step, F.lit(n))) <= F.col("_order")),
                at + step,
            ).otherwise(at),
        )
    ranged = docs.withColumn("_range", place)
    # At most one row per range, so its broadcast does not grow with the rows.
    firsts = ranged.groupBy("_range").agg(F.max("_order").alias("_order"))
    up = Window.orderBy("_range")
    moves = firsts.select(
        "_order", F.coalesce(F.lead("_range").over(up), F.first("_range").over(up)).alias("_to")
    )
    # A range's rows are followed by the next lower range's first row; the lowest by the highest's.
    extras = ranged.drop("_range").join(F.broadcast(moves), "_order").withColumnRenamed("_to", "_range")
    columns = [*docs.columns, "_range"]
    return ranged.select(*columns, F.lit(False).alias("_extra")).union(
        extras.select(*columns, F.lit(True).alias("_extra"))
    )


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row and version (0 the text, 1 its edited text): keys of its place, and the version's text.

    Edited: the last third of the code points is replaced by as many from the start of the next
    document by descending id; the first follows the last.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("_order"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    )
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    inside = Window.partitionBy("_range").orderBy("_extra", F.desc("_order"), "_text")
    third = F.floor(F.col("n_chars") / 3).cast("int")
    placed = (
        _bucketed(rows, buckets)
        .withColumn("_place", F.row_number().over(inside))
        .withColumn("_next", F.coalesce(F.lead("_text").over(inside), F.lit("")))
        .withColumn("n_chars", F.length("_text").cast("long"))
    )
    kept = F.substring("_text", F.lit(1), (F.col("n_chars") - third).cast("int"))
    edited = F.concat(kept, F.substring("_next", F.lit(1), third))
    versions = F.when(
        F.col("_extra"), F.array(F.struct(F.lit(0).alias("version"), F.col("_text").alias("text")))
    ).otherwise(
        F.array(
            F.struct(F.lit(0).alias("version"), F.col("_text").alias("text")),
            F.struct(F.lit(1).alias("version"), edited.alias("text")),
        )
    )
    return placed.select("_range", "_place", "_extra", "doc_id", "n_chars", F.explode(versions).alias("_v")).select(
        "_range", "_place", "_extra", "doc_id", "n_chars", "_v.version", "_v.text"
    )


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and edited text, their likeness, and the next text's likeness."""
    versions = with_edits(docs, id_col, text_col).withColumn(
        "sha", F.when(F.col("version") == 1, F.sha2(F.col("text").cast("binary"), 256))
    )
    keys = ["_range", "_place", "version", "_extra", "doc_id", "n_chars", "sha"]
    prints = fingerprint_rows(versions, keys, "text")
    words = [f"fp{k}" for k in range(WORDS)]
    order = Window.partitionBy("_range").orderBy("_place", "version")
    beside = prints.select(
        "*",
        F.lead("sha").over(order).alias("edited_sha256"),
        *[F.lead(w).over(order).alias(f"edited_{w}") for w in words],
        *[F.lead(w, 2).over(order).alias(f"next_{w}") for w in words],
    ).where("version = 0 AND NOT _extra")
    mine = [F.col(w) for w in words]
    edited = [F.col(f"edited_{w}") for w in words]
    following = [F.col(f"next_{w}") for w in words]
    likeness = lambda other: (1 - distance(mine, other) / (64.0 * WORDS)).cast("double")
    return beside.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hexadecimal(mine).alias("fingerprint"),
        hexadecimal(edited).alias("edited_fingerprint"),
        likeness(edited).alias("near_edited"),
        likeness(following).alias("near_next"),
        *words,
    )


def op10_fingerprints(spark, sf_dir) -> DataFrame:
    compared, _ = written(compare_edits(table(spark, sf_dir, "documents")), "fingerprints")
    words = [f"fp{k}" for k in range(WORDS)]
    near = near_classes(compared)
    links = F.coalesce("n_links", F.lit(0).cast("long"))
    return compared.join(near, words, "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
        (links > 0).alias("has_near"),
        F.coalesce("near_class", "doc_id").alias("near_class"),
        links.alias("n_links"),
    )
