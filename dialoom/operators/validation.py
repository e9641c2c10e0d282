"""Rules over dialogues, source trees and alignments, as long tables of violations.

A rule is a predicate and a message. All rules of a record become one array
expression, so a table is judged in one scan; nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from dialoom.config import ALIGNED_SPEAKER, ALIGNMENT_TOLERANCE, CATEGORIES, EXPECTED_COUNTS, MAX_TURNS, MAX_UTTERANCE_CHARS, MIN_TURNS, SPEAKERS, SPLITS, VOICE_POOLS
from dialoom.functions import text as tx
from dialoom.sources import dialogues

def reasons(*rules: tuple[Column, Column | str]) -> Column:
    """The messages of the rules that hold, in order."""
    return F.array_compact(F.array(*[F.when(p, m if isinstance(m, Column) else F.lit(m)) for p, m in rules]))


def quoted(value: Column) -> Column:
    return F.when(value.isNull(), F.lit("None")).otherwise(F.concat(F.lit("'"), value.cast("string"), F.lit("'")))


def turn_label(i: Column) -> Column:
    return F.concat(F.lit("turn["), i.cast("string"), F.lit("]"))


def text_reasons(i: Column, speaker: Column, text: Column) -> Column:
    """What is wrong with a non-blank text."""
    at = lambda m: F.concat(turn_label(i), F.lit(m))
    return reasons(
        (tx.has_control(text), at(" contains control characters")),
        (tx.has_unsupported(text), at(" contains unsupported unicode characters")),
        (tx.has_url(text), at(" contains a URL")),
        (tx.has_markdown(text), at(" contains markdown syntax")),
        (tx.too_long(text), at(f" exceeds max utterance length ({MAX_UTTERANCE_CHARS} chars)")),
        ((speaker == "assistant") & (F.size(tx.tokens(text)) == 0), at(" normalizes to an empty forced-alignment transcript")),
    )


def turn_reasons(i: Column, speaker: Column, text: Column) -> Column:
    who = reasons((~F.coalesce(speaker.isin(*SPEAKERS), F.lit(False)), F.concat(turn_label(i), F.lit(" has invalid speaker "), quoted(speaker))))
    blank = text.isNull() | tx.is_blank(text)
    said = F.when(blank, F.array(F.concat(turn_label(i), F.lit(" text must be nonempty")))).otherwise(text_reasons(i, speaker, text))
    return F.concat(who, said)


def count_reasons(turns: Column) -> Column:
    n = F.size(turns)
    bad = (n < MIN_TURNS) | (n > MAX_TURNS) | (n % 2 != 0)
    return reasons((bad, F.concat(F.lit(f"turns must have an even count between {MIN_TURNS} and {MAX_TURNS}, got "), n.cast("string"))))


def order_reasons(turns: Column) -> Column:
    """Who begins, who ends, and the first place where one speaks twice."""
    speaker = lambda i: F.get(turns, i)["speaker"]
    twice = F.get(F.filter(F.sequence(F.lit(1), F.greatest(F.size(turns) - 1, F.lit(1))), lambda i: speaker(i) == speaker(i - 1)), F.lit(0))
    return reasons(
        (speaker(F.lit(0)) != "user", "first speaker must be 'user'"),
        (F.element_at(turns, -1)["speaker"] != "assistant", "final speaker must be 'assistant'"),
        (twice.isNotNull(), F.concat(turn_label(twice), F.lit(" does not alternate speaker with "), turn_label(twice - 1))),
    )


def category_reasons(category: Column, allowed: tuple[str, ...]) -> Column:
    blank = category.isNull() | tx.is_blank(category)
    return F.when(blank, F.array(F.lit("category must be a nonempty string"))).otherwise(
        reasons((~category.isin(*allowed), F.concat(F.lit("category "), quoted(category), F.lit(" is not in the allowed category set"))))
    )


def record_reasons(id_: Column, category: Column, turns: Column, allowed: tuple[str, ...] = CATEGORIES) -> Column:
    """Why a typed dialogue is no valid source record; order is judged only if all else is right."""
    of_category = category_reasons(category, allowed)
    each = F.flatten(F.transform(turns, lambda t, i: turn_reasons(i, t["speaker"], t["text"])))
    first = F.concat(of_category, count_reasons(turns), each)
    return (
        F.when(id_.isNull() | tx.is_blank(id_), F.array(F.lit("id must be a nonempty string")))
        .when(turns.isNull() | (F.size(turns) == 0), F.concat(of_category, F.array(F.lit("turns must be a nonempty list"))))
        .otherwise(F.when(F.size(first) > 0, first).otherwise(order_reasons(turns)))
    )


def structure_reasons(turns: Column) -> Column:
    """Count, speakers and order alone, without the text gates."""
    bad = F.exists(turns, lambda t: ~F.coalesce(t["speaker"].isin(*SPEAKERS), F.lit(False)))
    first = F.concat(count_reasons(turns), reasons((bad, "invalid speaker")))
    return F.when(F.size(first) > 0, first).otherwise(order_reasons(turns))


def violations(dialogues_: DataFrame, allowed: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """(split, id, reason): one row a reason."""
    why = record_reasons(F.col("id"), F.col("category"), F.col("turns"), allowed)
    return dialogues_.select("split", "id", F.explode(why).alias("reason"))


# ---- raw records ---------------------------------------------------------------


def keys(v: Column) -> Column:
    return F.json_object_keys(v.cast("string"))


def kind(v: Column) -> Column:
    """The JSON type of a variant, without what is within it: STRING, ARRAY, OBJECT, ..."""
    return F.regexp_extract(F.schema_of_variant(v), r"^([A-Z]+)", 1)


def key_list(names: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(names), quoted), ", "), F.lit("]"))


def parse(raw: DataFrame, allowed: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """Raw records (split, ref, line_no, v) with ``reasons`` and typed id, category and turns."""
    field = lambda v, name: F.try_variant_get(v, f"$.{name}", "variant")
    string = lambda v: F.when(kind(v) == "STRING", v.cast("string"))
    v = F.col("v")
    wanted = F.array(*map(F.lit, ("category", "id", "turns")))
    d = raw.withColumn("kind", kind(v)).withColumn("keys", F.when(F.col("kind") == "OBJECT", keys(v)))
    d = d.withColumn("id", string(field(v, "id"))).withColumn("category", string(field(v, "category"))).withColumn("items", F.when(kind(field(v, "turns")) == "ARRAY", F.try_variant_get(v, "$.turns", "array<variant>")))
    turn = lambda t: F.struct(
        F.when(kind(t) == "OBJECT", string(field(t, "speaker"))).alias("speaker"),
        F.when(kind(t) == "OBJECT", string(field(t, "text"))).alias("text"),
        ((kind(t) == "OBJECT") & F.coalesce(F.array_sort(keys(t)) == F.array(F.lit("speaker"), F.lit("text")), F.lit(False))).alias("formed"),
    )
    d = d.withColumn("parts", F.transform("items", turn))
    each = F.flatten(
        F.transform("parts", lambda t, i: F.when(~t["formed"], F.array(F.concat(turn_label(i), F.lit(" must have exactly keys 'speaker' and 'text'")))).otherwise(turn_reasons(i, t["speaker"], t["text"])))
    )
    of_category = category_reasons(F.col("category"), allowed)
    first = F.concat(of_category, count_reasons(F.col("items")), each)
    extra, missing = F.array_except("keys", wanted), F.array_except(wanted, F.col("keys"))
    why = (
        F.when(v.isNull(), F.array(F.lit("invalid JSON")))
        .when(F.col("kind") != "OBJECT", F.array(F.lit("record must be a JSON object")))
        .when((F.size(extra) > 0) | (F.size(missing) > 0), F.array(F.concat(F.lit("unexpected keys (extra="), key_list(extra), F.lit(", missing="), key_list(missing), F.lit(")"))))
        .when(F.col("id").isNull() | tx.is_blank(F.col("id")), F.array(F.lit("id must be a nonempty string")))
        .when(F.col("items").isNull() | (F.size("items") == 0), F.concat(of_category, F.array(F.lit("turns must be a nonempty list"))))
        .otherwise(F.when(F.size(first) > 0, first).otherwise(order_reasons(F.col("parts"))))
    )
    said = F.transform("parts", lambda t: F.struct(t["speaker"].alias("speaker"), t["text"].alias("text")))
    d = d.select("split", "ref", "line_no", "id", "category", said.alias("turns"), why.alias("why"), F.monotonically_increasing_id().alias("row"))
    # A filter on the reasons must not be pushed below and spelled out within their lambdas: the row number holds it.
    return d.select("split", "ref", "line_no", "id", "category", "turns", F.when(F.col("row") >= 0, F.col("why")).alias("reasons"))


@dataclass(frozen=True)
class SourceTree:
    """Valid records and all problems of a source tree."""

    records: DataFrame
    problems: DataFrame
    missing: list[str] = field(default_factory=list)


class SourceInvalid(ValueError):
    def __init__(self, problems: list, total: int):
        self.problems = problems
        more = f"\n  ... and {total - len(problems)} more" if total > len(problems) else ""
        super().__init__(f"{total} source problem(s):\n" + "\n".join(f"  - {p.ref}: {p.reason}" for p in problems) + more)


def count_problems(found: DataFrame, expected: dict[str, int]) -> DataFrame:
    """Splits whose number of valid records isn't the expected one: (split, expected, found, reason)."""
    spark = found.sparkSession
    want = spark.createDataFrame(list(expected.items()), "split string, expected long")
    have = found.groupBy("split").agg(F.count("*").alias("n"))
    j = want.join(F.broadcast(have), "split", "left").withColumn("found", F.coalesce("n", F.lit(0)))
    return j.where("found <> expected").select("split", "expected", "found", F.format_string("expected %d records, found %d", "expected", "found").alias("reason"))


def id_problems(records: DataFrame, order: Column, splits: tuple[str, ...] = SPLITS) -> DataFrame:
    """(split, id, reason): ids that come twice in a split, and ids of an earlier split.

    Windows by id see the few rows of one id.
    """
    rank = F.coalesce(*[F.when(F.col("split") == s, F.lit(k)) for k, s in enumerate(splits)], F.lit(len(splits)))
    d = records.withColumn("rank", rank)
    d = d.withColumn("nth", F.row_number().over(Window.partitionBy("split", "id").orderBy(order)))
    d = d.withColumn("first_split", F.min_by("split", "rank").over(Window.partitionBy("id"))).withColumn("first_rank", F.min("rank").over(Window.partitionBy("id")))
    why = reasons(
        (F.col("nth") > 1, F.concat(F.lit("duplicate id within "), F.col("split"))),
        (F.col("first_rank") < F.col("rank"), F.concat(F.lit("id appears in both "), quoted(F.col("first_split")), F.lit(" and "), quoted(F.col("split")), F.lit(" (split overlap)"))),
    )
    return d.select("split", "id", F.explode(why).alias("reason"))


def check_tree(spark: SparkSession, root: str, splits: tuple[str, ...] = SPLITS, allowed: tuple[str, ...] = CATEGORIES, expected: dict[str, int] | None = None) -> SourceTree:
    """Judge all records of a tree. ``expected=None``: the usual counts; ``{}``: counts aren't judged."""
    raw, missing = dialogues.read_tree(spark, root, splits)
    counts = {s: n for s, n in (EXPECTED_COUNTS if expected is None else expected).items() if s in splits and s not in missing}
    empty = "split string, ref string, line_no long, id string, category string, turns array<struct<speaker:string,text:string>>, reasons array<string>"
    parsed = parse(raw, allowed) if raw is not None else spark.createDataFrame([], empty)
    good = parsed.where(F.size("reasons") == 0).select("split", "id", "category", "turns", "line_no")
    problems = parsed.select("split", "ref", F.explode("reasons").alias("reason"))
    lost = spark.createDataFrame([(s, s, f"missing authoritative split file: {root}/{s}.jsonl") for s in missing], "split string, ref string, reason string")
    problems = problems.unionByName(lost).unionByName(id_problems(good, F.col("line_no"), splits).withColumnRenamed("id", "ref"))
    if counts:
        problems = problems.unionByName(count_problems(good, counts).select("split", F.col("split").alias("ref"), "reason"))
    return SourceTree(good, problems, missing)


def require_valid(tree: SourceTree, shown: int = 200) -> DataFrame:
    total = tree.problems.count()
    if total:
        raise SourceInvalid(tree.problems.limit(shown).collect(), total)
    return tree.records


# ---- alignments ----------------------------------------------------------------


def alignment_violations(items: DataFrame, keys_: tuple[str, ...], duration: Column) -> DataFrame:
    """(*keys, pos, reason) over exploded alignments ``(*keys, pos, word, start, end, speaker)``.

    The end before an item is that of the last one with finite times.
    """
    w = Window.partitionBy(*keys_).orderBy("pos")
    finite = F.col("start").isNotNull() & F.col("end").isNotNull() & ~F.isnan("start") & ~F.isnan("end") & (F.abs("start") != float("inf")) & (F.abs("end") != float("inf"))
    d = items.withColumn("ok", finite).withColumn("before", F.last(F.when(finite, F.col("end")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    at = lambda m: F.concat(F.lit("alignments["), F.col("pos").cast("string"), F.lit(f"]{m}"))
    why = reasons(
        (F.col("word").isNull() | tx.is_blank(F.col("word")), at(".word must be a nonempty string")),
        (~F.col("speaker").eqNullSafe(F.lit(ALIGNED_SPEAKER)), at(f".speaker must be '{ALIGNED_SPEAKER}'")),
        (~F.col("ok"), at(" timestamps must be finite")),
        (F.col("ok") & (F.col("start") < 0), at(" start must be nonnegative")),
        (F.col("ok") & (F.col("end") <= F.col("start")), at(" end must be greater than start")),
        (F.col("ok") & (F.col("end") > duration + ALIGNMENT_TOLERANCE), at(" end exceeds duration")),
        (F.col("ok") & (F.col("start") < F.col("before")), at(" start is before the previous end")),
    )
    return d.select(*keys_, "pos", F.explode(why).alias("reason"))


def alignment_reasons(items: Column, duration: Column) -> Column:
    """The same rules for an array of (word, start, end, speaker) in one row; null or empty arrays are a reason."""
    def good(t: Column) -> Column:
        return t["start"].isNotNull() & t["end"].isNotNull() & ~F.isnan(t["start"]) & ~F.isnan(t["end"]) & (F.abs(t["start"]) != float("inf")) & (F.abs(t["end"]) != float("inf"))

    at = lambda i, m: F.concat(F.lit("alignments["), i.cast("string"), F.lit(f"]{m}"))

    def judge(t: Column, i: Column) -> Column:
        last = F.try_element_at(F.filter(F.slice(items, F.lit(1), i), good), F.lit(-1))["end"]
        return reasons(
            (t["word"].isNull() | tx.is_blank(t["word"]), at(i, ".word must be a nonempty string")),
            (~t["speaker"].eqNullSafe(F.lit(ALIGNED_SPEAKER)), at(i, f".speaker must be '{ALIGNED_SPEAKER}'")),
            (~good(t), at(i, " timestamps must be finite")),
            (good(t) & (t["start"] < 0), at(i, " start must be nonnegative")),
            (good(t) & (t["end"] <= t["start"]), at(i, " end must be greater than start")),
            (good(t) & (t["end"] > duration + ALIGNMENT_TOLERANCE), at(i, " end exceeds duration")),
            (good(t) & (t["start"] < last), at(i, " start is before the previous end")),
        )

    return F.when(items.isNull() | (F.size(items) == 0), F.array(F.lit("alignments must be nonempty"))).otherwise(F.flatten(F.transform(items, judge)))


# ---- voice pools ---------------------------------------------------------------


def pool_table(spark: SparkSession, pools: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(split, ord, voice): the configured pools as a dimension of a few dozen rows."""
    rows = [(s, k, v) for s, vs in (pools or VOICE_POOLS).items() for k, v in enumerate(vs)]
    return spark.createDataFrame(rows, "split string, ord int, voice string")


def pool_problems(pool: DataFrame, available: DataFrame | None = None) -> DataFrame:
    """(reason): voices of two pools, and configured voices that aren't available."""
    a, b = pool.alias("a"), pool.alias("b")
    shared = a.join(b, (F.col("a.voice") == F.col("b.voice")) & (F.col("a.split") < F.col("b.split")))
    out = shared.select(F.concat(F.lit("voice "), F.col("a.voice"), F.lit(" is in "), F.col("a.split"), F.lit(" and "), F.col("b.split")).alias("reason"))
    if available is not None:
        gone = pool.select("voice").distinct().join(available, "voice", "left_anti")
        out = out.unionByName(gone.select(F.concat(F.lit("voice "), F.col("voice"), F.lit(" is not available")).alias("reason")))
    return out
