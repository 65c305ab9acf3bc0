"""Document fingerprints: invertible Bloom lookup sketches of paragraph
digests, in DataFrame and SQL functions only.

A text's paragraphs (sentences and lines) are hashed to 64 bits. A sketch has
three subtables; each digest is added to one cell of each: the cell counts its
digests and keeps the xor of the digests and of their check hashes. Two
sketches subtract cell by cell, what both have cancels, and peeling cells that
hold a single digest recovers the differing digests. If cells remain, both
sketches are made again, larger and with other cell hashes, from the same
digests. The likeness is common / (common + differing) digests.

The published sketch has the distinct paragraphs of the whole text, whatever
their number. The larger ones of a text with more than ``BLOCKS`` paragraphs are
made in parts by the digests' low bits, about ``PART`` digests each, and peeled
part by part; this changes the work, not the digests that are compared.

Defined results: null and empty texts have no paragraphs; two texts without
paragraphs are alike (1.0). Repeated paragraphs count once. Next documents go
by descending identifier, nulls last, rows that repeat an identifier by text;
a single document is its own next. Empty tables give empty tables; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.llm.text import whole_text

PARAGRAPH = r"(?<=[.!?])\\s+|\\n+"     # as an SQL string
BLOCKS = 8                            # paragraphs whose larger sketches are made in one part
PART = 4                              # paragraphs of a part above that
BASE_WIDTH = 8                        # cells of a subtable of the published sketch
FIRST_WIDTH = 4                       # cells that a part's subtable has beyond half its digests
ROUNDS = (5, 4, 6, 10)                # peeling rounds of the published sketch and of the three of a part


def digests_of(text: Column) -> Column:
    """Paragraph digests in order."""
    return F.transform(F.filter(F.split(text, PARAGRAPH.replace("\\\\", "\\")), lambda p: F.length(p) > 0), lambda p: F.xxhash64(p))


def with_parts(df: DataFrame, a: str, b: str, over: str, out: str) -> DataFrame:
    """``df`` with ``out``: the digests of ``a`` and ``b`` in parts by their low
    bits, as many as their number asks for (in two steps, so that no part looks
    at all digests), each with its size n; none where ``over`` holds.

    The numbers of parts are columns of their own: inside a lambda they would
    be worked out again for every digest.
    """
    need = f"(size({a}_k) + size({b}_k))"
    bits, low, first, second = (f"__{out}_{x}" for x in ("bits", "low", "first", "second"))
    df = df.withColumn(bits, F.expr(f"CASE WHEN {over} OR {need} <= {2 * BLOCKS} THEN 0 ELSE cast(ceil(log2(cast({need} as double) / {2 * PART}D)) as int) END"))
    df = df.withColumn(low, F.expr(f"cast({bits} div 2 as int)"))
    df = df.withColumns({first: F.expr(f"cast(shiftleft(1, {low}) as int)"), second: F.expr(f"cast(shiftleft(1, {bits} - {low}) as int)")})

    def split(keys: str) -> str:
        one = f"transform(sequence(0, {first} - 1), i -> filter({keys}, k -> pmod(k, {first}) = i))"
        return (f"flatten(transform({one}, f -> transform(sequence(0, {second} - 1), "
                f"i -> filter(f, k -> pmod(shiftright(k, {low}), {second}) = i))))")
    parts = f"zip_with({split(f'{a}_k')}, {split(f'{b}_k')}, (x, y) -> named_struct('a', x, 'b', y, 'n', size(x) + size(y)))"
    return df.withColumn(out, F.expr(f"CASE WHEN {over} THEN array() ELSE {parts} END")).drop(bits, low, first, second)


def _places(k: str, w: str, salt: int) -> str:
    return ", ".join(f"cast(pmod(xxhash64({k}, {3 * salt + j}), {w}) + {j} * {w} as int) AS i{j}" for j in range(3))


def cells(keys: str, w: str, salt: int) -> str:
    """Sketch of an array of digests: 3 w cells (n, k, h)."""
    zero = "named_struct('n', 0, 'k', 0L, 'h', 0L)"
    tables = []
    for j in range(3):
        placed = f"transform({keys}, k -> struct(cast(pmod(xxhash64(k, {3 * salt + j}), {w}) as int) AS i, k AS k, xxhash64(k, -1) AS h))"
        tables.append(f"transform(array({placed}), p -> transform(sequence(0, {w} - 1), c -> aggregate(filter(p, x -> x.i = c), "
                      f"{zero}, (a, x) -> named_struct('n', a.n + 1, 'k', a.k ^ x.k, 'h', a.h ^ x.h))))[0]")
    return f"concat({', '.join(tables)})"


def minus(a: str, b: str) -> str:
    return f"zip_with({a}, {b}, (a, b) -> named_struct('n', a.n - b.n, 'k', a.k ^ b.k, 'h', a.h ^ b.h))"


def peel(diff: str, w: str, salt: int, rounds: int, when: str = "true") -> str:
    """(c, got): the cells left after ``rounds`` rounds (none unless ``when``)
    and the number of digests recovered. A round takes the digests of all
    single cells out. Every round copies the cells, so rounds are few; what
    they leave goes to a larger sketch."""
    pure = (f"array_distinct(transform(filter(s.c, x -> abs(x.n) = 1 and xxhash64(x.k, -1) = x.h), x -> "
            f"struct(x.n AS n, x.k AS k, x.h AS h, {_places('x.k', w, salt)})))")
    taken = ("transform(s.c, (x, c) -> aggregate(filter(p, p -> p.i0 = c or p.i1 = c or p.i2 = c), x, "
             "(a, p) -> named_struct('n', a.n - p.n, 'k', a.k ^ p.k, 'h', a.h ^ p.h)))")
    steps = f"sequence(1, {rounds})" if when == "true" else f"CASE WHEN {when} THEN sequence(1, {rounds}) ELSE array() END"
    return (f"aggregate({steps}, named_struct('c', {diff}, 'got', 0), (s, r) -> transform(array({pure}), p -> "
            f"if(size(p) = 0, s, named_struct('c', {taken}, 'got', s.got + size(p))))[0])")


def with_sketch(df: DataFrame, d: str) -> DataFrame:
    """``df`` with ``d``_k (distinct digests) and ``d``_c (cells of the smallest
    sketch) for the digest array ``d``."""
    df = df.withColumn(f"{d}_k", F.array_distinct(d))
    return df.withColumn(f"{d}_c", F.expr(cells(f"{d}_k", str(BASE_WIDTH), 0)))


def published(d: str) -> Column:
    """The fingerprint as text: number of digests and the cells in hexadecimal."""
    return F.expr(f"concat_ws(':', size({d}_k), array_join(transform({d}_c, x -> concat_ws('.', hex(x.n), hex(x.k), hex(x.h))), ','))")


def with_likeness(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """``df`` with ``out``: likeness of the sketched digest arrays ``a`` and
    ``b`` by subtracting and peeling, retrying larger until nothing is left."""
    r, left, differ = (f"__{out}_{x}" for x in ("r", "left", "differ"))
    need = f"(size({a}_k) + size({b}_k))"
    done = "forall({0}.c, x -> x.n = 0 and x.k = 0 and x.h = 0)"
    df = df.withColumn(r, F.expr(peel(minus(f"{a}_c", f"{b}_c"), str(BASE_WIDTH), 0, ROUNDS[0], f"abs(size({a}_k) - size({b}_k)) <= {3 * BASE_WIDTH}")))
    over = done.format(r)
    df = with_parts(df, a, b, over, left).withColumn(differ, F.expr(f"CASE WHEN {over} THEN {r}.got ELSE 0 END"))
    for salt, w in enumerate((f"({FIRST_WIDTH} + shiftright(pr.n, 1))", "(8 + pr.n)", "(64 + 2 * pr.n)"), 1):
        df = df.withColumn(left, F.expr(f"transform({left}, pr -> named_struct('a', pr.a, 'b', pr.b, 'n', pr.n, 'w', {w}))"))
        attempt = peel(minus(cells("pr.a", "pr.w", salt), cells("pr.b", "pr.w", salt)), "pr.w", salt, ROUNDS[salt])
        df = df.withColumn(r, F.expr(f"transform({left}, pr -> named_struct('pr', pr, 'r', {attempt}))"))
        over = done.format("t.r")
        df = (df.withColumn(differ, F.expr(f"{differ} + aggregate(filter({r}, t -> {over}), 0, (n, t) -> n + t.r.got)"))
              .withColumn(left, F.expr(f"transform(filter({r}, t -> not {over}), t -> t.pr)")))
    # What four sizes left (never seen) is compared by the digests themselves.
    rest = f"aggregate({left}, 0, (n, t) -> n + size(array_except(t.a, t.b)) + size(array_except(t.b, t.a)))"
    df = df.withColumn(differ, F.expr(f"{differ} + {rest}"))
    common = f"(({need} - {differ}) / 2)"
    return df.withColumn(out, F.expr(f"CASE WHEN {need} = 0 THEN 1.0D ELSE cast({common} / ({common} + {differ}) as double) END")).drop(r, left, differ)


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, next_text, and d's digests and sketch; n's of the next
    document): each row with its next document by descending identifier, after
    the last the first.

    Rows go to ranges of identifiers between sampled quantiles; the first row
    of each range also goes, as a guest, to the end of the range before.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = min(1000, 8 * partitions)                     # several ranges a partition, so that these are alike in size
    splits = src.select(F.percentile_approx("id", [i / n for i in range(1, n)] or [0.5], 10 * n)).first()[0]
    splits = sorted(set(splits or []))
    cut = F.array(*[F.lit(s).cast("long") for s in splits]) if splits else F.array().cast("array<bigint>")
    part = F.coalesce(F.size(F.filter(cut, lambda s: s <= F.col("id"))), F.lit(0))
    part = F.when(F.col("id").isNull(), -1).otherwise(part)
    tops = [(r["part"], r["top"]) for r in src.select(part.alias("part"), "id").groupBy("part").agg(F.max("id").alias("top"))
            .orderBy("part").collect()]               # at most one row per quantile
    # The first row of a range is the guest of the next higher one; the very first, of the lowest.
    hosts = [(top, tops[(k + 1) % len(tops)][0]) for k, (_, top) in enumerate(tops)]
    guests = F.broadcast(spark.createDataFrame(hosts, "top long, host int"))
    placed = (src.join(guests, F.col("id").eqNullSafe(F.col("top")), "left")
              .select("id", "text", F.posexplode(F.array_compact(F.array(part, F.col("host")))).alias("guest", "part"))
              .repartition(partitions, "part").withColumn("d", digests_of(F.col("text"))))
    order = Window.partitionBy("part").orderBy("guest", F.col("id").desc_nulls_last(), "text")
    parts = ["_k", "_c"]
    return (with_sketch(placed, "d").withColumn("next_text", F.lead("text").over(order))
            .withColumns({f"n{x}": F.lead(f"d{x}").over(order) for x in parts})
            .where(F.col("guest") == 0).drop("guest", "part", "d"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, fingerprint (see ``published``)."""
    return (with_sketch(docs.select(F.col(id_col).alias("id"), digests_of(whole_text(text_col)).alias("d")), "d")
            .select(F.col("id").alias(id_col), published("d").alias("fingerprint")))


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. The edited text has the last floor(n_chars / 3)
    code points replaced by the first as many of the next document."""
    rows = with_next(docs, id_col, text_col).withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - cut).cast("int")),
                                              F.substring(F.col("next_text"), F.lit(1), cut)))
    sketched = [f"{d}{x}" for d in ("d", "n") for x in ("_k", "_c")]
    rows = rows.select("id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), *sketched, digests_of(F.col("edited")).alias("e"))
    rows = with_likeness(with_likeness(with_sketch(rows, "e"), "d", "e", "near_edited"), "d", "n", "near_next")
    return rows.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", published("d").alias("fingerprint"),
                       published("e").alias("edited_fingerprint"), "near_edited", "near_next")
