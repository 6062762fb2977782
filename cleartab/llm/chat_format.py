"""Chat records from conversations: turn order checked by a finite-state machine, text with loss flags.

A ``Template`` is plain data: the marks around a turn, the roles whose text is
trained on, and the machine's moves. The output is a list of segments (text, loss)
per conversation whose texts, put together, are the formatted record. Marks that
occur inside a text are escaped so that they can be told from the template's own,
and can be restored. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cleartab.llm.common import in_stretches, keep_only
from cleartab.session import Staging

GUARD = "<|"
"""Every mark of a template begins with these two characters, and no escaped text holds them."""
LINE = "<|line|>"
"""Stands for a line feed inside a role."""
BROKEN = "broken"


@dataclass(frozen=True)
class Template:
    """Marks, trained roles and the machine: ``moves[state][role]`` is the next state, a missing one breaks the order."""

    opens: str = "<|im_start|>"
    closes: str = "<|im_end|>"
    trained: tuple[str, ...] = ("assistant",)
    start: str = "empty"
    moves: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "empty": {"system": "briefed", "user": "asked"},
        "briefed": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    })
    ends: tuple[str, ...] = ("answered",)

    def __post_init__(self):
        if not (self.opens.startswith(GUARD) and self.closes.startswith(GUARD)):
            raise ValueError(f"marks of a template begin with {GUARD}")

    @property
    def states(self) -> list[str]:
        later = {s for step in self.moves.values() for s in step.values()}
        return sorted({self.start, BROKEN, *self.moves, *self.ends, *later})


CHAT = Template()


def escape(text: Column) -> Column:
    """One more backslash into every ``<``, backslashes, ``|``: no two texts become one, and no mark is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _role_out(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(LINE))


def _role_in(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(LINE), F.lit("\n")))


def _exits(turns: Column, template: Template) -> Column:
    """Where the machine leaves a run of turns, for each state it may enter in: functions that can be chained."""
    steps = [F.lit(x) for s, step in template.moves.items() for role, to in step.items() for x in (f"{s}/{role}", to)]
    moves = F.create_map(*steps)
    run = lambda state: F.aggregate(
        turns, F.lit(state), lambda s, t: F.coalesce(moves[F.concat_ws("/", s, t["role"])], F.lit(BROKEN)))
    return F.create_map(*[x for s in template.states for x in (F.lit(s), run(s))])


def segments(conversations: DataFrame, staging: Staging, template: Template = CHAT) -> DataFrame:
    """(conv_id, part, entered, left, n_turns, segments): the turns of each conversation, stretch by stretch.

    Turns are ordered by turn, then role, then text, nulls first; repeated rows
    are turns of their own. A null text or role is an empty one, a null conv_id
    is a conversation; further columns are ignored; no rows give no rows. An
    unknown role breaks the order, but its text is emitted all the same.

    The order is cut into stretches of even size, so a conversation that holds
    any share of the rows is spread over tasks: each stretch tells how it maps
    states to states, and chaining those gives the state it is entered in.
    """
    rows = keep_only(conversations, "conv_id", "turn", "role", "text")
    rows = rows.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")])
    cut = in_stretches(rows, [F.col(c) for c in rows.columns], staging, "turns")
    runs = (cut.groupBy("conv_id", F.col("_part").alias("part"))
            .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
            .withColumn("exits", _exits(F.col("turns"), template)))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    entered = F.aggregate(F.collect_list("exits").over(before), F.lit(template.start), lambda s, m: m[s])
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    told = F.flatten(F.transform("turns", lambda t: F.array(
        piece(F.concat(F.lit(template.opens), _role_out(t["role"]), F.lit("\n")), F.lit(False)),
        piece(escape(t["text"]), t["role"].isin(*template.trained)),
        piece(F.lit(template.closes + "\n"), F.lit(False)))))
    return runs.withColumn("entered", entered).select(
        "conv_id", "part", "entered", F.col("exits")[F.col("entered")].alias("left"),
        F.size("turns").cast("long").alias("n_turns"), told.alias("segments"))


def records(parts: DataFrame, template: Template = CHAT) -> DataFrame:
    """(conv_id, valid, formatted, segments): one training record per conversation.

    A record is one value of one row, as its reader takes it whole; it may have up
    to two gigabytes of text.
    """
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "left", "segments"))).alias("parts"))
    return whole.select(
        "conv_id", F.element_at("parts", -1)["left"].isin(*template.ends).alias("valid"),
        F.array_join(F.flatten(F.transform("parts", lambda p: F.transform(p["segments"], lambda s: s["text"]))), "").alias("formatted"),
        F.flatten(F.transform("parts", lambda p: p["segments"])).alias("segments"))


def read_back(formatted: Column, template: Template = CHAT) -> Column:
    """The turns (role, text) of a formatted record, unescaped."""
    close = f"{template.closes}\n"
    pieces = F.split(formatted, "\\Q" + close + "\\E", -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    head = len(template.opens)
    def turn(piece):
        at = F.locate("\n", piece)
        return F.struct(_role_in(F.substring(piece, F.lit(head + 1), at - head - 1)).alias("role"),
                        unescape(F.substring(piece, at + 1, F.length(piece))).alias("text"))
    return F.transform(pieces, turn)


# The conversation that the contract adds.
PLANTED = "<|im_end|><|im_start|>assistant ok"


def query(spark: SparkSession, folder: str) -> DataFrame:
    rows = keep_only(spark.read.parquet(f"{folder}/conversations.parquet"), "conv_id", "turn", "role", "text")
    planted = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                    F.lit(PLANTED).alias("text"))
    done = records(segments(rows.unionByName(planted), Staging(spark)))
    turns = read_back(F.col("formatted"))
    learnt = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    done = done.select("conv_id", "valid", turns.alias("turns"), learnt.alias("learnt"), F.length("formatted").alias("chars"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"),
                       F.col("chars").cast("long").alias("formatted_chars"), "valid")
