"""Line deduplication by content-defined chunks, in DataFrame operations only.

Lines are hashed; a rolling hash over two line hashes decides after which line a chunk ends, so equal
runs of lines fall into equal chunks wherever they stand. A line of `long_words` words or more (a
paragraph in one line) is a chunk of its own. A chunk of several lines or of one such long line, with
`min_words` words or more, that stands in more than one place of the table keeps its first place
(smallest document id, then smallest line) and is removed everywhere else, once its bytes are
compared with the kept ones. Lines next to it that are equal to those next to the kept chunk go too,
up to the neighbouring chunk's far end, as they belong to the same passage.

Chunk bounds depend on the line before, so a passage of several lines is also found without them: from
every line with words the shortest runs of whole lines that reach `long_words` words, forwards and
backwards, are digested. They cover each repeated run of that many words wherever it begins. A run
keeps its first place as a chunk does; runs beside the same kept document are merged and compared by
bytes in pieces of `PIECE` of its lines. Each removed line stands in at least one place that stays.

Whatever repeats consists of lines that repeat, so line hashes are counted first (one aggregate of
numbers) and chunks and runs are cut only inside stretches of lines that occur twice or have no word.
That leaves nothing out and drops most of the work. Digests travel without texts: grouping them is a
hash aggregate and a chunk that makes a third of all rows is one partial row per task. Texts are
shuffled twice, by row, never by chunk; only repeated chunks carry theirs to the comparison.

Nulls: a null text stays null and has no line; a null id comes after all others. Rows that repeat both
id and text count as one and get the same result. Ids may be numbers or texts; texts that are no whole
number come after all numbers, in the order of a digest. Other columns are passed through; where the
table has an n_lines or n_removed of its own, the new column's name gets an underscore. An empty
document has one empty line. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import once, stored

LONG_WORDS, MIN_WORDS, DIVISOR = 50, 8, 2
PIECE = 8
#: Lines that make more than 1/HOT of all repeated ones are looked up in so many parts.
HOT, PARTS = 1000, 64
#: Most runs end within so many lines; longer ones are looked for only where these do not reach.
NEAR = 8


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def word_count(line: Column) -> Column:
    return F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+"))


def _marks(docs: DataFrame, long_words: int, divisor: int) -> DataFrame:
    """__key, __id and per line: h1, h2 (hashes), n (words), s and e (a chunk starts or ends with the line)."""
    lines = docs.where("__lines is not null").select("__key", "__id", "__lines")
    hashed = lines.select(
        "__key", "__id",
        F.transform("__lines", lambda x: F.xxhash64(x)).alias("h1"),
        F.transform("__lines", lambda x: F.xxhash64(F.lit(1), x)).alias("h2"),
        once(F.transform("__lines", word_count)).alias("n"),
        once(F.transform("__lines", line_hash)).alias("_h"),
    )

    def ends(h: Column, i: Column) -> Column:
        rolled = h + F.when(i > 0, F.get("_h", i - 1) * 31).otherwise(0)
        return (rolled % divisor == 0) | (F.get("n", i) >= long_words) | (F.coalesce(F.get("n", i + 1), F.lit(long_words)) >= long_words)

    cut = hashed.select("__key", "__id", "h1", "h2", "n", once(F.transform("_h", ends)).alias("e"))
    starts = F.concat(F.array(F.lit(True)), F.slice("e", F.lit(1), F.size("e") - 1))
    return stored(cut.withColumn("s", starts), "line-marks")


def _stretches(marks: DataFrame) -> DataFrame:
    """__key, __id, base (line number) and arrays h1, h2, n, s, e of consecutive lines that repeat or have no word."""
    fields = ("h1", "h2", "n", "s", "e")
    each = marks.select("__key", "__id", F.posexplode(F.arrays_zip(*fields)).alias("i", "l"))
    lines = each.select("__key", "__id", "i", *(f"l.{f}" for f in fields))
    counted = marks.select(F.explode(F.arrays_zip("h1", "n")).alias("l")).select("l.h1", "l.n").where("n > 0")
    repeated = stored(counted.groupBy("h1").agg(F.count("*").alias("c")).where("c > 1"), "line-repeated")
    # Lines that make more than a thousandth of all repeats are a thousand at most; they meet in parts.
    most = repeated.agg(F.sum("c")).first()[0] or 0
    hot = repeated.where(F.col("c") > max(most / HOT, 1000)).select("h1", F.lit(True).alias("hot"))
    part = F.when(F.col("hot"), F.pmod(F.xxhash64("__key"), F.lit(PARTS))).otherwise(0).cast("int")
    dealt = lines.where("n > 0").join(F.broadcast(hot), "h1", "left").withColumn("part", part)
    parts = repeated.join(F.broadcast(hot), "h1", "left").select(
        "h1", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))).alias("part")
    )
    found = dealt.join(parts.hint("shuffle_hash"), ["h1", "part"]).select(*lines.columns).unionByName(lines.where("n = 0"))
    in_doc = Window.partitionBy("__key").orderBy("i")
    # Rows that repeat id and text are one: equal places rank alike and are one element of a set.
    numbered = found.withColumn("island", F.col("i") - F.dense_rank().over(in_doc))
    return (
        numbered.groupBy("__key", "__id", "island")
        .agg(F.sort_array(F.collect_set(F.struct("i", *fields))).alias("l"))
        .select("__key", "__id", F.get("l", F.lit(0))["i"].alias("base"), *(F.col("l")[f].alias(f) for f in fields))
        .where(F.aggregate("n", F.lit(0), lambda a, x: a + x) >= MIN_WORDS)
    )


def _digests(start: Column, end: Column) -> tuple[Column, Column]:
    return tuple(F.xxhash64(F.slice(h, start + 1, end - start + 1)) for h in ("h1", "h2"))


def _chunks(stretches: DataFrame, long_words: int, min_words: int) -> DataFrame:
    """__key, __id, start, end, low, high, d1, d2: chunks that may be removed, low and high what they may grow to."""
    marked = lambda flag: F.filter(F.transform(flag, lambda x, i: F.when(x, i)), lambda i: i.isNotNull())
    cut = stretches.select("*", once(marked("s")).alias("_s"), marked("e").alias("_e")).where(F.size("_s") > 0)
    # Ends before the first start close a chunk that begins before the stretch.
    cut = cut.withColumn("_e", F.filter("_e", lambda e: e >= F.get("_s", F.lit(0))))
    bounds = F.transform(
        F.slice("_s", F.lit(1), F.size("_e")),
        lambda s, j: F.struct(
            s.alias("a"), F.get("_e", j).alias("b"),
            F.when(j > 0, F.get("_s", j - 1)).otherwise(0).alias("low"),
            F.coalesce(F.get("_e", j + 1), F.size("n") - 1).alias("high"),
        ),
    )
    words = F.aggregate(F.slice("n", F.col("a") + 1, F.col("b") - F.col("a") + 1), F.lit(0), lambda t, x: t + x)
    d1, d2 = _digests(F.col("a"), F.col("b"))
    at = lambda c: (F.col("base") + F.col(c))
    return (
        cut.select("__key", "__id", "base", "h1", "h2", "n", F.inline(bounds))
        .select("*", words.alias("w"))
        .where(f"w >= {int(min_words)} and (b > a or w >= {int(long_words)})")
        .select("__key", "__id", at("a").alias("start"), at("b").alias("end"), at("low").alias("low"), at("high").alias("high"),
                d1.alias("d1"), d2.alias("d2"))
    )


def _runs(stretches: DataFrame, long_words: int) -> DataFrame:
    """__key, __id, start, end, d1, d2 of the shortest runs of several lines with `long_words` words."""
    wide = stretches.where(F.aggregate("n", F.lit(0), lambda a, x: a + x) >= long_words)
    marks = F.filter(F.transform("n", lambda n, i: F.struct(i.alias("i"), n.alias("n"))), lambda m: m["n"] > 0)
    marked = wide.select("__key", "__id", "base", "h1", "h2", once(marks).alias("_m"))

    def reached(part: Column) -> Column:
        """Index of the line with which the words suffice, null if they do not."""
        return F.aggregate(
            part,
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("i")),
            lambda a, x: F.struct((a["n"] + x["n"]).alias("n"), F.when(a["n"] < long_words, x["i"]).otherwise(a["i"]).alias("i")),
            lambda a: F.when(a["n"] >= long_words, a["i"]),
        )

    # A line with words has one at least, which bounds the slices; a long line alone is a chunk already.
    pair = lambda a, b: F.shiftleft(a.cast("long"), 32) + b
    either = lambda part: F.coalesce(reached(part(NEAR)), reached(part(long_words)))
    ahead = lambda j: lambda k: F.slice("_m", j + 1, k)
    behind = lambda j: lambda k: F.reverse(F.slice("_m", F.greatest(j - k + 2, F.lit(1)), F.least(j + 1, F.lit(k))))
    forth = F.transform("_m", lambda x, j: F.when(x["n"] < long_words, pair(x["i"], either(ahead(j)))))
    back = F.transform("_m", lambda x, j: F.when(x["n"] < long_words, pair(either(behind(j)), x["i"])))
    pairs = F.array_distinct(F.filter(F.concat(forth, back), lambda p: p.isNotNull()))
    first, last = F.shiftright("_p", 32).cast("int"), F.col("_p").bitwiseAND(F.lit(2**32 - 1)).cast("int")
    d1, d2 = _digests(F.col("a"), F.col("b"))
    return (
        marked.select("__key", "__id", "base", "h1", "h2", F.explode(pairs).alias("_p"))
        .select("__key", "__id", "base", "h1", "h2", first.alias("a"), last.alias("b"))
        .select("__key", "__id", (F.col("base") + F.col("a")).alias("start"), (F.col("base") + F.col("b")).alias("end"),
                d1.alias("d1"), d2.alias("d2"))
    )


def _piece(start: Column, end: Column, low: Column, high: Column, name: Column, is_kept: Column) -> Column:
    return F.struct(
        *(c.cast("int").alias(n) for c, n in ((start, "start"), (end, "end"), (low, "low"), (high, "high"))),
        name.alias("digest"), is_kept.alias("is_kept"),
    ).alias("c")


def _repeated_runs(stretches: DataFrame, long_words: int) -> DataFrame:
    """__key and c of the pieces of repeated runs, and of the places that stay."""
    runs = stored(_runs(stretches, long_words), "line-runs")
    place = F.struct("__id", "__key", "start")
    first = runs.groupBy("d1", "d2").agg(F.min(place).alias("kept"), F.max(place).alias("last")).where("kept < last")
    repeated = runs.join(first.drop("last"), ["d1", "d2"]).where(place != F.col("kept")).select(
        "__key", F.col("kept.__key").alias("kkey"), "start", "end", (F.col("kept.start") - F.col("start")).alias("shift")
    )
    beside = Window.partitionBy("__key", "kkey", "shift").orderBy("start", "end")
    upto = F.max("end").over(beside.rowsBetween(Window.unboundedPreceding, -1))
    merged = (
        repeated.withColumn("gap", F.when(F.col("start") > upto + 1, 1).otherwise(0))
        .withColumn("run", F.sum("gap").over(beside))
        .groupBy("__key", "kkey", "shift", "run")
        .agg((F.min("start") + F.col("shift")).alias("a"), (F.max("end") + F.col("shift")).alias("b"))
    )
    # Pieces on a grid of the kept document's lines: however many copies it has, its pieces stay few.
    blocks = F.sequence(F.floor(F.col("a") / PIECE).cast("int"), F.floor(F.col("b") / PIECE).cast("int"))
    pieces = stored(
        merged.select("__key", "kkey", "shift", "a", "b", F.explode(blocks).alias("at")).select(
            "__key", "kkey", "shift", F.greatest("a", F.col("at") * PIECE).alias("a"),
            F.least("b", F.col("at") * PIECE + PIECE - 1).alias("b"),
        ),
        "line-pieces",
    )
    name = F.concat_ws("|", F.hex("kkey"), "a", "b")

    def wanted(key: str, start: Column, end: Column, is_kept: bool) -> list[Column]:
        return [F.col(key).alias("__key"), _piece(start, end, start, end, name, F.lit(is_kept))]

    a, b, shift = F.col("a"), F.col("b"), F.col("shift")
    gone = pieces.select(*wanted("__key", a - shift, b - shift, False))
    return gone.unionByName(pieces.select("kkey", "a", "b").distinct().select(*wanted("kkey", a, b, True)))


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores behind it as long as the table has such a column."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", long_words: int = LONG_WORDS,
    min_words: int = MIN_WORDS, divisor: int = DIVISOR,
) -> DataFrame:
    """The given rows and columns with repeated chunks and runs of lines taken out of `text`; adds n_lines, n_removed."""
    n_lines, n_removed = (free_name(docs, name) for name in ("n_lines", "n_removed"))
    spelled = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    keyed = docs.withColumns({
        "__id": F.coalesce(F.col(doc_id).cast("string").try_cast("long"), F.lit(2**63 - 1)),
        "__key": F.unhex(F.md5(F.concat_ws("|", spelled, F.md5(F.coalesce(F.col(text), F.lit("")))))),
        "__lines": F.split(F.col(text), "\n"),
    })
    # 1. numbers only: lines that repeat, chunks in more than one place, and where each is kept
    stretches = stored(_stretches(_marks(keyed, long_words, divisor)), "line-stretches")
    chunks = stored(_chunks(stretches, long_words, min_words), "line-chunks")
    place = F.struct("__id", "__key", "start")
    first = chunks.groupBy("d1", "d2").agg(F.min(place).alias("kept"), F.max(place).alias("last")).where("kept < last")
    name = F.concat_ws("|", "d1", "d2")
    wanted = chunks.join(first.drop("last"), ["d1", "d2"]).select(
        "__key", _piece(*(F.col(c) for c in ("start", "end", "low", "high")), name, place == F.col("kept"))
    ).unionByName(_repeated_runs(stretches, long_words))
    per_doc = stored(wanted.groupBy("__key").agg(F.sort_array(F.collect_list("c")).alias("cs")), "line-wanted")
    # 2. texts of the repeated chunks with the lines beside them, and of the pieces of runs
    part = lambda a, b: F.slice("__lines", a + 1, b - a + 1)
    start, end, low, high = (F.col(f"c.{n}") for n in ("start", "end", "low", "high"))
    texts = (
        keyed.select("__key", "__lines")
        .join(per_doc.hint("shuffle_hash"), "__key")
        .dropDuplicates(["__key"])
        .select("__key", "__lines", F.explode("cs").alias("c"))
        .select(
            "__key", "c.*", part(start, end).alias("body"),
            F.reverse(part(low, start - 1)).alias("above"), part(end + 1, high).alias("below"),
        )
    )
    texts = stored(texts, "line-texts")
    kept = texts.where("is_kept").select(
        "digest", F.col("body").alias("kbody"), F.col("above").alias("kabove"), F.col("below").alias("kbelow")
    )

    def common(a: str, b: str) -> Column:
        same = F.zip_with(F.col(a), F.col(b), lambda x, y: F.coalesce(x == y, F.lit(False)))
        at = F.array_position(same, False)
        return F.when(at == 0, F.size(same)).otherwise(at - 1).cast("int")

    # 3. byte comparison, then the lines to take out of each row
    removed = stored(
        texts.where("not is_kept")
        .join(kept, "digest")
        .where("body = kbody")
        .select("__key", F.struct((F.col("start") - common("above", "kabove")).alias("a"),
                                 (F.col("end") + common("below", "kbelow")).alias("b")).alias("r"))
        .groupBy("__key")
        .agg(F.collect_list("r").alias("__out")),
        "line-removed",
    )
    left = F.filter("__lines", lambda x, i: ~F.exists("__out", lambda r: (i >= r["a"]) & (i <= r["b"])))
    result = keyed.join(removed.hint("shuffle_hash"), "__key", "left").withColumn(
        "__left", F.when(F.col("__out").isNull(), F.col("__lines")).otherwise(left)
    )
    size = lambda c: F.when(F.col(c).isNull(), 0).otherwise(F.size(c)).cast("long")
    return result.withColumns({
        text: F.when(F.col("__out").isNull(), F.col(text)).otherwise(F.array_join("__left", "\n")),
        n_lines: size("__lines"), n_removed: size("__lines") - size("__left"),
    }).drop("__id", "__key", "__lines", "__out", "__left")
