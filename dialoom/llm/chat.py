"""Chat formatting with typed content parts, DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

OPEN, CLOSE, END = "<|", "|>", "<|end|>"
#: Model tokens that one unit of an attachment stands for: an image tile, a second of audio, a page.
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 400}


def escape(text: Column) -> Column:
    """Make control strings harmless: afterwards neither ``<|`` nor ``|>`` occurs.

    Backslashes double, then one goes between the two signs. A single backslash
    between them can come from nothing else, so ``unescape`` gives the text back.
    """
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("<|"), F.lit("<\\|"))
    return F.replace(out, F.lit("|>"), F.lit("|\\>"))


def unescape(text: Column) -> Column:
    out = F.replace(text, F.lit("|\\>"), F.lit("|>"))
    out = F.replace(out, F.lit("<\\|"), F.lit("<|"))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def visit(part: Column) -> Column:
    """One typed part as template text: text escaped, an attachment as a placeholder naming its kind.

    A part of another kind, or a null kind, counts as text.
    """
    kind = F.coalesce(part["kind"], F.lit("text"))
    return F.when(kind.isin(*UNIT_TOKENS), F.concat(F.lit(OPEN), kind, F.lit(CLOSE))).otherwise(escape(F.coalesce(part["text"], F.lit(""))))


def text_parts(turns: DataFrame) -> DataFrame:
    """Turns of plain text as turns of one text part each."""
    part = F.struct(F.lit("text").alias("kind"), F.coalesce("text", F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(0).cast("long").alias("units"))
    return turns.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def format_chats(turns: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """One row a conversation from ``turns(conv_id, turn, role, parts)``.

    ``parts`` is an array of (kind, text, ref, units). Columns: conv_id, n_turns,
    formatted, loss_spans (start and length in code points of the bodies written by
    ``learn_from``), attachments (kind, ref and expanded tokens, in the order of
    their placeholders) and attachment_tokens. Turns are ordered by turn, then role
    and content, nulls first; repeated rows stay. A null role or part is empty; null
    conversation ids are one conversation; an empty table gives an empty one. A
    conversation is one string of the result, so its turns meet in one task, sorted
    with spilling; offsets are running sums, not carried by the rows' order.
    """
    parts = F.coalesce(F.col("parts"), F.array().cast("array<struct<kind:string,text:string,ref:string,units:bigint>>"))
    body = F.array_join(F.transform(parts, visit), "")
    kept = F.filter(parts, lambda p: F.coalesce(p["kind"], F.lit("text")).isin(*UNIT_TOKENS))
    rate = F.create_map(*[F.lit(x) for kv in UNIT_TOKENS.items() for x in kv])
    attached = F.transform(kept, lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), (F.coalesce(p["units"], F.lit(0)) * F.element_at(rate, p["kind"])).alias("tokens")))
    role = F.coalesce(F.col("role"), F.lit(""))
    d = turns.select("conv_id", "turn", role.alias("role"), F.concat(F.lit("<|turn:"), escape(role), F.lit(CLOSE)).alias("head"), body.alias("body"), attached.alias("attached"))
    d = d.withColumn("piece", F.concat("head", "body", F.lit(END)))
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    before = F.coalesce(F.sum(F.length("piece")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    d = d.select("conv_id", F.row_number().over(w).alias("k"), "piece", "attached", (before + F.length("head")).alias("start"), F.length("body").alias("length"), (F.col("role") == learn_from).alias("learn"))
    rows = F.sort_array(F.collect_list(F.struct("k", "piece", "attached", "start", "length", "learn")))
    g = d.groupBy("conv_id").agg(rows.alias("rows"))
    learnt = F.filter("rows", lambda r: r["learn"])
    return g.select(
        "conv_id", F.size("rows").cast("long").alias("n_turns"),
        F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"),
        F.transform(learnt, lambda r: F.struct(r["start"].cast("long").alias("start"), r["length"].cast("long").alias("length"))).alias("loss_spans"),
        F.flatten(F.transform("rows", lambda r: r["attached"])).alias("attachments"),
    ).withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text), unescaped."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: p != "")
    head = lambda p: F.substring_index(p, CLOSE, 1)
    return F.transform(
        pieces,
        lambda p: F.struct(unescape(F.substring(head(p), F.lit(8), F.length(p))).alias("role"), unescape(F.substring(p, F.length(head(p)) + 3, F.length(p))).alias("text")),
    )


def read_parts(formatted: Column) -> Column:
    """The turns as an array of (role, parts), parts being (kind, text): the k-th that isn't text is the k-th attachment.

    A text that looks like a placeholder comes back as text, for it was escaped. Texts next to
    each other come back as one, empty ones not at all.
    """
    part = lambda kind, text: F.struct(kind.alias("kind"), text.alias("text"))
    text = lambda t: F.filter(F.array(part(F.lit("text"), unescape(t))), lambda p: p["text"] != "")
    after = lambda x: F.substring(x, F.length(F.substring_index(x, CLOSE, 1)) + 3, F.length(x))
    pieces = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: p != "")

    def turn(p: Column) -> Column:
        role = F.substring(F.substring_index(p, CLOSE, 1), F.lit(8), F.length(p))
        # Cut at each sign that opens a placeholder; none is in escaped text.
        return F.struct(unescape(role).alias("role"), F.flatten(F.transform(F.split(F.substring(p, 3, F.length(p)), r"<\|"), lambda x, k: F.concat(F.when(k > 0, F.array(part(F.substring_index(x, CLOSE, 1), F.lit("")))).otherwise(F.slice(F.array(part(F.lit(""), F.lit(""))), 1, 0)), text(after(x))))).alias("parts"))

    return F.transform(pieces, turn)


def under_mask(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask, spans in order with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
