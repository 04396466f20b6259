"""Chat formatting by quotation linking (native: DataFrame functions only).

Lines of a message start with ``>`` marks, one for each level of quoting.
Neighbouring quoted lines of one level are a passage. Passages are normalised
(letters and digits, lower case), hashed and joined to the hashes of what
messages say themselves: the whole message with its own quotes, its own text,
its paragraphs; passages of any level that find nothing so are tried by their
paragraphs, longer lines and runs of short neighbouring lines. Of several originals with one hash the last
one before the reply counts. The reply's parent is the message whose whole text
it quotes or, failing that, the one that explains most of its first-level
quotes. Following parents to the top gives conversations; a message keeps its
text without quotes and the lines that introduce them.

The "last one before" is found without gathering a hash in one task: time is
cut into slices of about as many messages each, the search runs within (hash, slice), and where a slice has no
earlier original the last one of the slices before counts. Conversations are
rows with root, parent and depth, so a thread of any size is never gathered.

Defined cases: null and empty texts quote nothing and say nothing; a null time
comes before all others; messages of one time never quote each other; equal
rows get equal results each; of equal originals at one time the one whose key
hashes highest counts; an empty table gives an empty result; a quote that matches
nothing leaves the message a root; clashing result columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketlab.llm.common import let, table, whole_row, written

MARK = r"^[ \t>]*>"  # no repeated group: those recurse in Java and end the JVM on long lines
# fixed values: how mail programs introduce a quote
INTRO = r"^\s*(On|Am|Le|El) .*(wrote|schrieb|a écrit|escribió)\s*:\s*$"
LINE_WORDS = 4  # shorter single lines identify nothing
SLICES = 1024  # slices of time, more when one would hold over SLICE_ROWS rows
SLICE_ROWS = 1 << 20
RESULT = ("parent", "conversation", "depth", "n_quotes", "n_linked", "said")
_NEVER = -(2**62)


def parsed_lines(text: Column) -> Column:
    """Lines in order: array of (level, body); level 0 is the message's own text.

    A line that introduces a deeper quote is left out.
    """

    def line(x: Column) -> Column:
        mark = F.regexp_extract(x, MARK, 0)
        level = F.char_length(mark) - F.char_length(F.replace(mark, F.lit(">"), F.lit("")))
        body = F.when(level > 0, F.regexp_replace(x, MARK + r"[ \t]?", "")).otherwise(x)
        return F.struct(level.alias("level"), body.alias("body"))

    every = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), line)
    deeper = lambda a, i, x: F.coalesce(F.get(a, i + 1)["level"] > x["level"], F.lit(False))
    return let(every, lambda a: F.filter(a, lambda x, i: ~(deeper(a, i, x) & x["body"].rlike(INTRO))))


def own_lines(lines: Column) -> Column:
    return F.transform(F.filter(lines, lambda x: x["level"] == 0), lambda x: x["body"])


def normal(text: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " ")))


def passages(lines: Column) -> Column:
    """Runs of neighbouring quoted lines of one level: array of (level, body)."""
    edge = F.filter(
        F.transform(lines, lambda x, i: F.struct(i.alias("at"), x["level"].alias("level"), (F.lit(i == 0) | ~F.get(lines, i - 1)["level"].eqNullSafe(x["level"])).alias("new"))),
        lambda x: x["new"],
    )

    def cut(e: Column) -> Column:
        def part(x: Column, k: Column) -> Column:
            end = F.coalesce(F.get(e, k + 1)["at"], F.size(lines))
            body = F.array_join(F.transform(F.slice(lines, x["at"] + 1, end - x["at"]), lambda y: y["body"]), "\n")
            return F.struct(x["level"].alias("level"), body.alias("body"))

        return F.filter(F.transform(e, part), lambda x: x["level"] > 0)

    return let(edge, cut)


def _keys(texts: Column) -> Column:
    """Distinct hashes of the normalised texts that hold any word."""
    return F.array_distinct(F.transform(F.filter(F.transform(texts, normal), lambda x: x != ""), lambda x: F.xxhash64(x)))


def _runs(lines: Column) -> Column:
    """From every line with words: the shortest run of lines with LINE_WORDS words, and the line pair if it has fewer.

    Array of (text, weight), the text normalised, the weight that of the first line: runs that overlap count each line once.
    """

    def of(a: Column) -> Column:
        def at(x: Column, i: Column) -> Column:
            text = lambda k: F.array_join(F.slice(a, i + 1, k), " ")
            enough = lambda k: F.size(F.split(text(k), " ")) >= LINE_WORDS
            least = F.lit(None).cast("string")
            for k in range(LINE_WORDS, 0, -1):
                least = F.when(enough(k), text(k)).otherwise(least)
            pair = F.when((i + 1 < F.size(a)) & ~enough(2), text(2))
            return F.transform(F.array(least, pair), lambda t: F.struct(t.alias("text"), F.char_length(x).alias("weight")))

        return F.filter(F.flatten(F.transform(a, at)), lambda t: t["text"].isNotNull())

    return let(F.filter(F.transform(lines, normal), lambda x: x != ""), of)


def _parts(lines: Column) -> Column:
    """Distinct (h, weight) of the paragraphs and runs of lines."""
    whole = F.transform(F.transform(_paragraphs(lines), normal), lambda t: F.struct(t.alias("text"), F.char_length(t).alias("weight")))
    every = F.filter(F.concat(whole, _runs(lines)), lambda x: x["text"] != "")
    return F.array_distinct(F.transform(every, lambda x: F.struct(F.xxhash64(x["text"]).alias("h"), x["weight"].alias("weight"))))


def _paragraphs(lines: Column) -> Column:
    return F.split(F.array_join(F.transform(lines, F.trim), "\n"), "\n\n+")


def cuts(times: DataFrame) -> list[int]:
    """Least to greatest, the times (``ord``) that part the rows into slices of about one size; null times aside."""
    known = times.where(F.col("ord") != _NEVER)
    n = max(SLICES, known.count() // SLICE_ROWS)
    found = known.agg(F.percentile_approx("ord", [k / n for k in range(1, n)], 10 * n).alias("c")).first()["c"]
    return sorted(set(found or []))


def slice_of(time: Column, at: list[int]) -> Column:
    """How many cuts lie before ``time``, by binary search; -1 for null times."""
    if not at:
        return F.when(time == _NEVER, F.lit(-1)).otherwise(F.lit(0)).cast("long")
    table_ = F.split(F.lit(",".join(map(str, at))), ",").cast("array<bigint>")
    steps = F.lit([2**k for k in reversed(range(len(at).bit_length()))])
    beyond = lambda t, i: F.coalesce(F.get(t, i - 1) < time, F.lit(False))
    place = let(table_, lambda t: F.aggregate(steps, F.lit(0), lambda i, k: F.when(beyond(t, i + k), i + k).otherwise(i)))
    return F.when(time == _NEVER, F.lit(-1)).otherwise(place).cast("long")


def last_before(quotes: DataFrame, originals: DataFrame, few: bool = False, at: list[int] | None = None) -> DataFrame:
    """``quotes`` (h, ord, ...) that have an original (h, ord, tie, key) of the same hash before them, with its ``found`` key.

    ``few``: the quotes are few beside the originals, which are first reduced to their hashes.
    ``at``: cuts of time (default: those of the rows given).
    """
    quotes = quotes.where(F.col("ord") != _NEVER)  # nothing is before a null time
    if few:
        originals = originals.join(quotes.select("h").distinct(), "h", "left_semi")
    slice_ = slice_of(F.col("ord"), cuts(quotes.select("ord").unionByName(originals.select("ord"))) if at is None else at)
    q = quotes.withColumn("slice", slice_)
    o = originals.select("h", slice_.alias("slice"), "ord", F.struct("ord", "tie", "key").alias("o"))
    rows = q.select("h", "slice", "ord", F.struct(*quotes.columns).alias("q"), F.lit(None).cast(o.schema["o"].dataType).alias("o"))
    rows = rows.unionByName(o.where("slice >= 0").withColumn("q", F.lit(None).cast(rows.schema["q"].dataType)))
    earlier = F.max("o").over(Window.partitionBy("h", "slice").orderBy("ord").rangeBetween(Window.unboundedPreceding, -1))
    near = written(rows.withColumn("near", earlier["key"]).where("q is not null").select("q.*", "slice", "near"), "near")
    found = near.where("near is not null").select(*quotes.columns, F.col("near").alias("found"))
    # no original earlier in the slice: the last one of the slices before, over one row a hash and slice
    missing = near.where("near is null").drop("near")
    asked = missing.select("h", "slice").distinct()
    last = o.join(asked.select("h").distinct(), "h", "left_semi").groupBy("h", "slice").agg(F.max("o").alias("last"))
    slots = last.unionByName(asked.withColumn("last", F.lit(None).cast(last.schema["last"].dataType)))
    prior = F.max("last").over(Window.partitionBy("h").orderBy("slice").rangeBetween(Window.unboundedPreceding, -1))
    slots = slots.withColumn("prior", prior["key"]).where("last is null and prior is not null").select("h", "slice", "prior")
    return found.unionByName(missing.join(slots, ["h", "slice"]).select(*quotes.columns, F.col("prior").alias("found")))


def link(messages: DataFrame, id_col: str = "id", time_col: str = "time", text_col: str = "text") -> DataFrame:
    """``messages`` with parent and conversation (ids), depth, n_quotes (passages), n_linked and
    ``said`` (own text). ``time_col`` is a whole number."""
    key = F.md5(F.concat_ws("\0", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.coalesce(F.col(time_col).cast("string"), F.lit("-")), F.coalesce(F.col(text_col), F.lit(""))))
    kept = messages.drop(*RESULT)
    base = kept.select(whole_row(kept).alias("row"), key.alias("_key"))
    m = messages.select(key.alias("_key"), F.col(id_col).alias("id"), F.coalesce(F.col(time_col).cast("long"), F.lit(_NEVER)).alias("ord"), parsed_lines(F.col(text_col)).alias("lines")).dropDuplicates(["_key"])
    m = m.withColumn("own", own_lines(F.col("lines")))
    whole = F.array_join("own", "\n")
    quoted = F.filter("lines", lambda x: x["level"] > 0)
    inner = F.filter(quoted, lambda x: x["level"] > 1)
    bodies = lambda lines: F.array_join(F.transform(lines, lambda x: x["body"]), "\n")
    # a message as a whole: own text, then everything it quotes, level marks set aside
    full = lambda own, rest: F.array(F.concat_ws("\n", F.lit("full"), own, bodies(rest)))
    first = bodies(F.filter(quoted, lambda x: x["level"] == 1))
    none = F.array().cast("array<string>")

    def asks(p: Column) -> Column:
        """A passage's hash and weight, and those of its parts."""
        parts = _parts(F.split(p["body"], "\n"))
        weigh = lambda t: F.struct(F.xxhash64(t).alias("h"), F.char_length(t).alias("weight"))
        return let(normal(p["body"]), lambda t: F.struct(p["level"].alias("level"), weigh(t).alias("all"), parts.alias("parts"), (t != "").alias("any")))

    m = m.select(
        "_key",
        F.xxhash64("_key").alias("tie"),
        "id",
        "ord",
        F.trim(F.regexp_replace(whole, r"^\n+|\n+$", "")).alias("said"),
        F.transform(passages(F.col("lines")), asks).alias("asks"),
        _keys(F.concat(F.when(F.trim(whole) != "", full(whole, quoted)).otherwise(none), F.array(whole), _paragraphs(F.col("own")))).alias("says"),
        F.array_distinct(F.transform(_parts(F.col("own")), lambda x: x["h"])).alias("parts"),
        F.when(F.size(quoted) > 0, F.get(_keys(full(first, inner)), F.lit(0))).alias("full"),
    )
    m = written(m.withColumn("key", F.monotonically_increasing_id()), "messages")

    at = cuts(m.select("ord"))
    said = lambda column: m.select(F.explode(column).alias("h"), "ord", "tie", "key")
    each = m.select(F.col("key").alias("reply"), "ord", F.posexplode("asks").alias("no", "a"))
    ask = each.where("a.any").select("a.all.h", "ord", "reply", "no", F.col("a.level").alias("level"), "a.all.weight")
    ask = ask.unionByName(m.where("full is not null").select(F.col("full").alias("h"), "ord", F.col("key").alias("reply"), F.lit(-1).alias("no"), F.lit(0).alias("level"), F.lit(0).alias("weight")))
    found = written(last_before(ask, said("says"), at=at), "quotes")
    rest = each.join(found.select("reply", "no"), ["reply", "no"], "left_anti")
    rest = written(rest.select("reply", "no", "ord", F.col("a.level").alias("level"), F.inline("a.parts")), "rest")
    found = found.unionByName(written(last_before(rest, said("parts"), few=True, at=at), "quotes"))

    votes = found.where("level <= 1").groupBy("reply", "found").agg(F.max(F.col("level") == 0).alias("whole"), F.sum("weight").alias("weight"))
    times = m.select(F.col("key").alias("found"), F.col("ord").alias("at"), "tie")
    best = votes.join(times, "found").groupBy("reply").agg(F.max(F.struct("whole", "weight", "at", "tie", "found")).alias("b")).select(F.col("reply").alias("key"), F.col("b.found").alias("up"))
    linked = found.where("no >= 0").groupBy(F.col("reply").alias("key")).agg(F.countDistinct("no").alias("n_linked"))

    # to the top: each round doubles how far up a message has looked
    start = m.select("key").join(best, "key", "left")
    tree = written(start.select("key", "up", F.coalesce("up", "key").alias("top"), F.col("up").isNotNull().cast("long").alias("depth")), "tree")
    while True:
        above = tree.select(F.col("key").alias("top"), F.col("top").alias("next"), F.col("depth").alias("more"))
        step = tree.join(above, "top").select("key", "up", F.col("next").alias("top"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("next") != F.col("top")).alias("moved"))
        step = written(step, "tree")
        tree = step.drop("moved")
        if not step.where("moved").limit(1).count():
            break
    names = m.select("key", "id")
    out = tree.join(names.select(F.col("key").alias("up"), F.col("id").alias("parent")), "up", "left").join(names.select(F.col("key").alias("top"), F.col("id").alias("conversation")), "top")
    out = out.select("key", "parent", "conversation", "depth").join(linked, "key", "left").join(m.select("key", "_key", "said", F.size("asks").cast("long").alias("n_quotes")), "key")
    out = out.select("_key", "parent", "conversation", "depth", "n_quotes", F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"), "said")
    return base.join(out, "_key").select("row.*", *RESULT)


def as_mail(conversations: DataFrame) -> DataFrame:
    """Conversation turns as mail: every turn quotes the turn before it, which quotes the one before that.

    A hash of (conversation, turn) says of each level whether it is quoted whole or trimmed to one line or two
    neighbouring ones. The prior turn is joined by (conversation, turn), so a conversation of any length stays spread out.
    """
    c = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    said = c.groupBy("conv_id", "turn").agg(F.min(F.struct("text", "role")).alias("m"))
    before = lambda k: said.select("conv_id", (F.col("turn") + k).alias("turn"), F.col("m.text").alias(f"t{k}"), F.col("m.role").alias(f"r{k}"))
    both = c.join(before(1), ["conv_id", "turn"], "left").join(before(2), ["conv_id", "turn"], "left")

    def trimmed(text: Column, level: int) -> Column:
        pick = F.xxhash64("conv_id", "turn", F.lit(level))
        start = F.pmod(F.shiftright(pick, 8), F.lit(2**31))
        some = lambda lines: F.slice(lines, (start % F.size(lines) + 1).cast("int"), F.pmod(pick, F.lit(3)).cast("int"))
        # without lines that identify anything, or by choice, all of it
        part = let(F.split(text, "\n"), lambda a: let(F.array_join(some(a), "\n"), lambda t: F.when(F.size(F.split(normal(t), " ")) >= LINE_WORDS, t)))
        return F.coalesce(part, text)

    quote = lambda text, mark: F.concat(F.lit(mark), F.replace(text, F.lit("\n"), F.lit("\n" + mark)))
    wrote = lambda role: F.concat(F.lit("On Monday "), role, F.lit(" wrote:"))
    one = F.when(F.col("t1").isNotNull(), F.concat(F.lit("\n\n"), wrote(F.col("r1")), F.lit("\n"), quote(trimmed(F.col("t1"), 1), "> ")))
    two = F.when(F.col("t1").isNotNull() & F.col("t2").isNotNull(), F.concat(F.lit("\n> "), wrote(F.col("r2")), F.lit("\n"), quote(trimmed(F.col("t2"), 2), "> > ")))
    text = F.concat(F.col("text"), F.coalesce(one, F.lit("")), F.coalesce(two, F.lit("")))
    return both.select(F.concat_ws("/", "conv_id", "turn").alias("id"), (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("time"), text.alias("text"))


# -- registered query -------------------------------------------------------
def op2_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = as_mail(table(spark, sf_dir, "conversations"))
    return link(mail).select("id", "parent", "conversation", "depth", "n_quotes", "n_linked", "said")
