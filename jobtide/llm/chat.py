"""Chat formatting in budgeted windows, with built-in functions only.

A conversation's turns are cut into spans by the prefix sums of their tokens: a stride of the budget holds the turns
that lie in it, and a turn across its edge joins them if they still fit together, else it is a span of its own. Each
window is a span after the conversation's system turn and a few turns of history. Only the assistant texts of the span
itself are under the loss mask, so a repeated one is masked and each is a target once.

Turns are marked ``<|im_start|>role`` and ``<|im_end|>``. In texts, a backslash is doubled and one is put after the
first character of each control string, so that none is left; ``unescape`` undoes both. Roles are percent-encoded.

Windows never cross a multiple of ``block`` turn numbers, so a conversation with very many turns is worked on in
blocks; history and the system turn reach across.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.arrow import quoted

START, END = "<|im_start|>", "<|im_end|>\n"
#: Strings that this template or that of other models gives a meaning.
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
BUDGET, HISTORY_TURNS, HISTORY_TOKENS, BLOCK = 1024, 2, 256, 256
#: A turn's tokens are taken as one for so many bytes.
BYTES_PER_TOKEN = 4


def escape(text: Column) -> Column:
    """The text without control strings."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        text = F.replace(text, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return text


def unescape(text: Column) -> Column:
    """The text as it was; every other backslash is doubled, so a single one marks a control string."""
    for control in reversed(CONTROL):
        text = F.replace(text, F.lit(control[0] + "\\" + control[1:]), F.lit(control))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def windows(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = BUDGET,
    history_turns: int = HISTORY_TURNS,
    history_tokens: int = HISTORY_TOKENS,
    block: int = BLOCK,
) -> DataFrame:
    """Windows of all conversations: ``conv``, ``window`` (ascending in a conversation), ``text``, ``n_tokens``,
    ``n_turns``, ``n_context`` (turns at its head that other windows have as well) and ``loss``, the stretches of the
    text (start and length in code points) that are targets.

    Turns are ordered by number (null first), then by role and text; null roles and texts are empty, and rows with a
    null ``conv`` are one conversation. The system turn is the first turn if its role is ``system``. A window holds
    up to ``budget`` tokens (one for each four bytes) unless a single turn or the context has too many: nothing is
    cut. Repeated rows are turns of their own; an empty table gives no windows.
    """
    given = conversations.select(
        quoted(conv).alias("conv"),
        F.coalesce(quoted(turn).cast("long"), F.lit(-(1 << 62))).alias("turn"),
        F.coalesce(quoted(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"),
    )
    given = given.withColumn("tokens", (F.floor(F.octet_length("text") / BYTES_PER_TOKEN) + 1).cast("long")).withColumn("block", F.floor(F.col("turn") / block))
    # the first turn of each conversation, if it is the system's
    first = given.groupBy("conv").agg(F.min(F.struct("turn", "role", "text", "tokens")).alias("first"))
    system = first.where("first.role = 'system'").select(F.col("conv").alias("of"), F.col("first.turn").alias("system_turn"), F.col("first.text").alias("system_text"), F.col("first.tokens").alias("system_tokens"), F.xxhash64("conv").alias("hash"))
    # a turn near the end of its block is also seen by the next one, as history
    last = F.col("turn") - F.col("block") * block >= block - history_turns
    blocks = F.when(last, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    seen = given.withColumn("later", F.explode(blocks)).withColumn("block", F.col("block") + F.col("later")).withColumn("own", F.col("later") == 0)
    # the hash lets adaptive execution split a hot conversation
    seen = seen.withColumn("hash", F.xxhash64("conv"))
    with_system = seen.join(system.select("of", "hash", "system_turn", "system_tokens"), (seen["hash"] == system["hash"]) & seen["conv"].eqNullSafe(system["of"]), "left").drop(system["hash"], "of")
    stride = F.greatest(F.lit(budget - history_tokens) - F.coalesce("system_tokens", F.lit(0)), F.lit(budget // 4))
    in_block = Window.partitionBy("conv", "block").orderBy("turn", "role", "text", "own")
    numbered = (
        with_system.withColumn("place", F.row_number().over(in_block))
        .withColumn("end", F.sum("tokens").over(in_block.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("end", F.col("end") - F.sum(F.when(~F.col("own"), F.col("tokens")).otherwise(0)).over(in_block.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("start", F.col("end") - F.when(F.col("own"), F.col("tokens")).otherwise(0))
        .withColumn("size", stride)
        .withColumn("stride", F.floor(F.col("start") / F.col("size")))
        .withColumn("crosses", F.col("end") > (F.col("stride") + 1) * F.col("size"))
    )
    in_stride = Window.partitionBy("conv", "block", "stride")
    spans = numbered.withColumn("total", F.sum(F.when(F.col("own"), F.col("tokens")).otherwise(0)).over(in_stride))
    alone = F.col("crosses") & (F.col("total") > F.col("size"))
    spans = spans.withColumn("span", F.when(F.col("own"), F.col("stride") * 2 + F.when(alone, 1).otherwise(0)))
    # a turn is history of the window that one of the next turns begins
    ordered = Window.partitionBy("conv", "block").orderBy("place")
    spans = spans.withColumn("begins", F.col("own") & ~F.lag("span").over(ordered).eqNullSafe(F.col("span")))
    spans = spans.withColumn("before", F.sum("tokens").over(ordered.rowsBetween(Window.unboundedPreceding, -1)))
    spans = spans.withColumn("before", F.coalesce("before", F.lit(0)))
    is_system = F.coalesce(F.col("turn") == F.col("system_turn"), F.lit(False)) & (F.col("role") == "system")
    copies = [F.when(F.col("own"), F.struct(F.col("span").alias("span"), F.lit(True).alias("new")))]
    for ahead in range(1, history_turns + 1):
        begins, before = F.lead("begins", ahead).over(ordered), F.lead("before", ahead).over(ordered)
        near = begins & (before - F.col("before") <= history_tokens) & ~is_system
        copies.append(F.when(near, F.struct(F.lead("span", ahead).over(ordered).alias("span"), F.lit(False).alias("new"))))
    pieces = spans.select("conv", "block", "place", "role", "text", "tokens", "hash", "system_turn", is_system.alias("is_system"), F.filter(F.array(*copies), lambda c: c.isNotNull()).alias("copies"))
    pieces = pieces.withColumn("copy", F.explode("copies")).select("conv", "hash", "block", F.col("copy.span").alias("span"), F.col("copy.new").alias("new"), "place", "role", "text", "tokens", "is_system")
    head = F.concat(F.lit(START), F.url_encode("role"), F.lit("\n"))
    body = escape(F.col("text"))
    target = F.when(F.col("new") & (F.col("role") == "assistant"), F.struct(F.length("head").alias("head"), F.length("body").alias("length")))
    pieces = pieces.withColumn("head", head).withColumn("body", body).withColumn("target", target)
    listed = F.sort_array(F.collect_list(F.struct("place", "new", "tokens", "is_system", F.concat("head", "body", F.lit(END)).alias("piece"), "target")))
    grouped = pieces.groupBy("conv", "hash", "block", "span").agg(listed.alias("turns"))
    grouped = grouped.withColumn("has_system", F.exists("turns", lambda t: t["is_system"]))
    texts = system.select("of", F.col("hash").alias("system_hash"), "system_text", "system_tokens")
    full = grouped.join(texts, (grouped["hash"] == texts["system_hash"]) & grouped["conv"].eqNullSafe(texts["of"]), "left")
    lead = F.when(~F.col("has_system") & F.col("system_text").isNotNull(), F.concat(F.lit(START + "system\n"), escape(F.col("system_text")), F.lit(END)))
    full = full.withColumn("lead", F.coalesce(lead, F.lit("")))
    context = F.size(F.filter("turns", lambda t: ~t["new"])) + F.when(F.col("lead") != "", 1).otherwise(0)
    # where each turn starts, and from that where its target does
    state = F.struct(F.length("lead").cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("found"))

    def step(so_far: Column, t: Column) -> Column:
        span = F.array(F.struct((so_far["at"] + t["target"]["head"]).alias("start"), t["target"]["length"].cast("long").alias("length")))
        found = F.when(t["target"].isNull(), so_far["found"]).otherwise(F.concat(so_far["found"], span))
        return F.struct((so_far["at"] + F.length(t["piece"])).alias("at"), found.alias("found"))

    return full.select(
        F.col("conv").alias(conv),
        F.struct("block", "span").alias("window"),
        F.concat("lead", F.array_join(F.transform("turns", lambda t: t["piece"]), "")).alias("text"),
        (F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["tokens"]) + F.when(F.col("lead") != "", F.col("system_tokens")).otherwise(0)).alias("n_tokens"),
        (F.size("turns") + F.when(F.col("lead") != "", 1).otherwise(0)).alias("n_turns"),
        context.alias("n_context"),
        F.aggregate("turns", state, step, lambda s: s["found"]).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns that are a window's own and the text under its loss mask, read from the formatted text.

    Adds ``turns`` (array of ``role`` and ``text``) and ``targets`` (array of texts) to the output of ``windows``.
    """
    parts = F.split("text", r"<\|im_start\|>", -1)
    own = F.slice(parts, F.col("n_context") + 2, F.size(parts))

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        text = F.substr(part, F.length(role) + 2, F.length(part) - F.length(role) - 1 - len(END))
        return F.struct(F.url_decode(role).alias("role"), unescape(text).alias("text"))

    targets = F.transform("loss", lambda s: unescape(F.substr(F.col("text"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.withColumn("turns", F.transform(own, turn)).withColumn("targets", targets)


def digest(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What the windows of each conversation hold, read back: turns, targets and their digests.

    A digest is over the whole conversation, so its text must fit into one value.
    """
    read = read_back(formatted)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    targets = F.array_join("targets", "")
    parts = F.sort_array(F.collect_list(F.struct("window", F.size("turns").alias("n"), turns.alias("turns"), targets.alias("targets"))))
    whole = read.select(conv, "window", "turns", "targets", F.length("text").alias("chars")).groupBy(conv).agg(parts.alias("parts"), F.sum("chars").cast("long").alias("formatted_chars"))
    loss = F.array_join(F.transform("parts", lambda p: p["targets"]), "")
    return whole.select(
        conv,
        F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["n"]).alias("n_turns"),
        F.sha2(F.array_join(F.transform("parts", lambda p: p["turns"]), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
