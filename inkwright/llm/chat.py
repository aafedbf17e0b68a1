"""Chat formatting: multi-party perspective rotation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Speakers that set the scene and are rendered alike from every perspective.
SCENE = ("system",)
#: What ends a turn.
END = "<|end|>"


def escaped(c: Column) -> Column:
    """A text in which no mark of the template stands: in "<|" and "|>" one more backslash follows the first character.

    Reversible, as every such pair has one backslash more than before.
    """
    c = F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")
    return F.regexp_replace(c, r"\|(\\*)>", r"|\\$1>")


def unescaped(c: Column) -> Column:
    """The text that was escaped."""
    c = F.regexp_replace(c, r"\|\\(\\*)>", r"|$1>")
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def rotate_perspectives(turns: DataFrame, conv: str = "conv_id", order: str = "turn", speaker: str = "role", text: str = "text", scene: tuple[str, ...] = SCENE) -> DataFrame:
    """Every dialogue once per participant, turn by turn, with that participant as the assistant.

    Returns a row per (conversation, perspective, turn): conv_id, perspective, turn, role, name,
    content, rendered, mask. From the perspective of p, turns of p have role "assistant", no
    name and mask 1 (trained on); other participants' turns have role "user", their speaker as
    name and mask 0; turns of `scene` speakers keep role "system" and mask 0 and have no
    perspective of their own. `rendered` is the turn in the template below, its name and content escaped so that neither can
    stand for a mark of the template; a dialogue is the concatenation of its rows by (turn, rendered).

    A null speaker is the participant "unknown"; null text is empty; very long texts count whole; rows with a null
    conversation stand for no dialogue and are left out. Repeated rows and equal turn numbers stay as they are.
    Conversations with only scene speakers have no perspective. Extra columns are ignored; an empty table gives no rows.
    Participants are found with a partially aggregated distinct and joined on the conversation,
    a join that skew handling can split, so a conversation with a third of all rows is never
    gathered in one task.
    """
    said = turns.where(F.col(conv).isNotNull()).select(F.col(conv).alias("conv_id"), F.col(order).alias("turn"), F.coalesce(F.col(speaker), F.lit("unknown")).alias("speaker"), F.coalesce(F.col(text), F.lit("")).alias("content"))
    is_scene = F.col("speaker").isin(*scene)
    people = said.where(~is_scene).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    own = F.col("speaker") == F.col("perspective")
    role = F.when(is_scene, "system").when(own, "assistant").otherwise("user")
    name = F.when(~is_scene & ~own, F.col("speaker"))
    rendered = F.concat(F.lit("<|"), role, F.coalesce(F.concat(F.lit(" name="), escaped(name)), F.lit("")), F.lit("|>\n"), escaped(F.col("content")), F.lit(END + "\n"))
    return said.join(people, "conv_id").select("conv_id", "perspective", "turn", role.alias("role"), name.alias("name"), "content", rendered.alias("rendered"), F.when(~is_scene & own, 1).otherwise(0).alias("mask"))


def with_places(rotated: DataFrame, chunk_turns: int = 256) -> DataFrame:
    """Rotated turns with their place in the rendered dialogue: start and end, and mask_start and mask_end, in characters.

    The masked span is what the assistant says and the end mark, without the header; null in turns of others. Places are
    running sums in chunks of `chunk_turns` turn numbers, on top of running sums of the chunks' lengths, so a long dialogue is not sorted
    in one task. Turns without a number come first.
    """
    dialogue = ["conv_id", "perspective"]
    rows = rotated.withColumn("chunk", F.coalesce(F.floor(F.col("turn") / chunk_turns), F.lit(-(2**62))).cast("long")).withColumn("size", F.length("rendered").cast("long"))
    sums = rows.groupBy(*dialogue, "chunk").agg(F.sum("size").alias("total"))
    before = F.sum("total").over(Window.partitionBy(*dialogue).orderBy("chunk")) - F.col("total")
    within = F.sum("size").over(Window.partitionBy(*dialogue, "chunk").orderBy("turn", "rendered").rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.withColumn("within", within).join(sums.select(*dialogue, "chunk", before.alias("base")), [*dialogue, "chunk"])
    end = F.col("base") + F.col("within")
    own = F.col("mask") == 1
    spans = [(end - F.col("size")).alias("start"), end.alias("end"), F.when(own, end - F.col("size") + F.lit(len("<|assistant|>\n"))).alias("mask_start"), F.when(own, end - 1).alias("mask_end")]
    return placed.select(*rotated.columns, *spans)


def render_samples(rotated: DataFrame, segment_turns: int = 512) -> DataFrame:
    """Training samples of rotated turns: conv_id, perspective, segment, text, masks.

    A sample holds the turns whose number falls into one segment of `segment_turns`, in order of
    (turn, rendered), so its size has a bound even for endless dialogues; ordinary dialogues are
    one sample, and the samples of a longer one, joined in order, are that dialogue. masks: an array with (start, end) character spans of the
    sample to train on: what the assistant says, and the end mark. Turns without a number are a segment of their own; an empty
    table gives no samples.
    """
    part = rotated.withColumn("segment", F.floor(F.col("turn") / segment_turns))
    turns = F.array_sort(F.collect_list(F.struct("turn", "rendered", "mask")))
    gathered = part.groupBy("conv_id", "perspective", "segment").agg(turns.alias("turns"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc, x):
        end = acc["at"] + F.length(x["rendered"])
        span = F.struct((acc["at"] + F.lit(len("<|assistant|>\n"))).alias("start"), (end - 1).alias("end"))
        return F.struct(end.alias("at"), F.when(x["mask"] == 1, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return gathered.select("conv_id", "perspective", "segment", F.array_join(F.transform("turns", lambda x: x["rendered"]), "").alias("text"), F.aggregate("turns", start, step, lambda acc: acc["spans"]).alias("masks"))
