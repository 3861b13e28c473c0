"""Chat formatting with Spark expressions only.

A conversation is formatted in parts of `PART` turn numbers, and a part of more rows than that (numbers that repeat or are null) in pieces of `PART` rows
of their sorted order, so that a task never holds more of a long one. Within a piece the turns are collected, sorted and merged by array aggregation:
adjacent turns of one role form one message

    <|im_start|>role\\ntext<|im_sep|>text<|im_end|>\\n

Inside roles and texts a backslash is doubled and `<|` becomes `<\\|`, so no text can look like a mark, and reading back gives each turn as it was.
A line end in a role becomes `<\\~`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrazzo.session import staged

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
#: turn numbers of a part, and rows of a piece; a power of two
PART = 256


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("<\\~"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("<\\~"), F.lit("\n")))


def merged(turns: Column) -> Column:
    """Array of (role, parts): adjacent turns of one role are one message."""
    none = F.array().cast("array<struct<role:string,parts:array<string>>>")

    def step(done: Column, turn: Column) -> Column:
        last = F.element_at(done, -1)
        same = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["role"] == turn["role"])
        more = F.struct(turn["role"].alias("role"), F.concat(last["parts"], F.array(turn["text"])).alias("parts"))
        new = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("parts"))
        return F.when(same, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(more))).otherwise(F.concat(done, F.array(new)))

    return F.aggregate(turns, none, step)


def _pieces(rows: DataFrame) -> DataFrame:
    """`rows` (conv, part, one) with `piece`: parts of more than `PART` rows are cut, in the order of their rows."""
    full = rows.groupBy(F.col("conv").alias("_conv"), F.col("part").alias("_part")).agg(F.count("*").alias("n")).where(F.col("n") > PART)
    full = staged(full.drop("n"), "full-parts")
    uncut = F.lit(0).cast("long")
    if full.isEmpty():
        return rows.withColumn("piece", uncut)
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))
    # equal rows are told apart by any number, so that no range of the sort holds them all
    dealt = rows.join(full, same, "left_semi").withColumn("tie", F.xxhash64(F.monotonically_increasing_id()))
    ordered = dealt.orderBy("conv", "part", "one", "tie")
    # runs of a sorted partition; written, since a repeated sort could cut elsewhere
    place = F.shiftright(F.monotonically_increasing_id(), PART.bit_length() - 1)
    cut = staged(ordered.select("conv", "part", "one", place.alias("piece")), "pieces")
    return rows.join(full, same, "left_anti").withColumn("piece", uncut).unionByName(cut)


def formatted_chat(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """conv, part, piece, formatted, loss: the formatted text of every conversation and the spans (start, length, in code points) that bear loss.

    A conversation is the texts of its parts and their pieces in order; a message goes on into the next one if the same role does.
    Turns go by number, null first, ties by role, then text; repeated rows stay. A null role or text is an empty
    one, a null conversation is one conversation. A part holds the turns of `PART` successive numbers,
    a piece of it `PART` rows at most.
    """  # noqa: E501
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.coalesce(F.floor(F.col(turn_col) / PART), F.lit(-(1 << 62))).alias("part"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        ).alias("one"),
    )
    rows = _pieces(rows)
    parts = rows.groupBy("conv", "part", "piece").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    # the roles at the seams, without the texts
    turn = F.struct("one.turn", "one.role", "one.text")
    seams = rows.groupBy("conv", "part", "piece").agg(F.min(turn)["role"].alias("first"), F.max(turn)["role"].alias("last"))
    by_part = Window.partitionBy("conv").orderBy("part", "piece")
    seams = seams.select(
        F.col("conv").alias("_conv"),
        F.col("part").alias("_part"),
        F.col("piece").alias("_piece"),
        F.coalesce(F.lag("last").over(by_part) == F.col("first"), F.lit(False)).alias("_goes_on"),
        F.coalesce(F.lead("first").over(by_part) == F.col("last"), F.lit(False)).alias("_open"),
    )
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")) & (F.col("piece") == F.col("_piece"))
    joined = parts.join(seams, same)
    escaped_turns = F.transform(
        "turns", lambda t: F.struct(escaped_role(t["role"]).alias("role"), escaped(t["text"]).alias("text"))
    )
    messages = joined.withColumn("messages", merged(escaped_turns))
    count = F.size("messages")

    def pieces(message: Column, i: Column) -> Column:
        """The strings of one message, each with whether it bears loss."""
        head = F.when((i == 0) & F.col("_goes_on"), F.lit(SEP)).otherwise(F.concat(F.lit(START), message["role"], F.lit("\n")))
        tail = F.when((i == count - 1) & F.col("_open"), F.lit("")).otherwise(F.lit(END))
        body = F.flatten(
            F.transform(
                message["parts"],
                lambda text, k: F.array(
                    F.struct(F.when(k == 0, head).otherwise(F.lit(SEP)).alias("text"), F.lit(False).alias("loss")),
                    F.struct(text.alias("text"), (message["role"] == loss_role).alias("loss")),
                ),
            )
        )
        return F.concat(body, F.array(F.struct(tail.alias("text"), F.lit(False).alias("loss"))))

    strings = messages.select("conv", "part", "piece", F.flatten(F.transform("messages", pieces)).alias("pieces"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def span(done: Column, piece: Column) -> Column:
        length = F.char_length(piece["text"])
        new = F.array(F.struct(done["at"].alias("start"), length.alias("length")))
        spans = F.when(piece["loss"] & (length > 0), F.concat(done["spans"], new)).otherwise(done["spans"])
        return F.struct((done["at"] + length).alias("at"), spans.alias("spans"))

    return strings.select(
        F.col("conv").alias(conv_col),
        "part",
        "piece",
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        F.aggregate("pieces", start, span, lambda done: done["spans"]).alias("loss"),
    )


def read_back(formatted: Column) -> Column:
    """Array of (role, text): the turns of a whole formatted conversation."""
    blocks = F.slice(F.split(formatted, r"<\|im_end\|>\n", -1), 1, F.size(F.split(formatted, r"<\|im_end\|>\n", -1)) - 1)

    def turns(block: Column) -> Column:
        content = F.substring(block, F.lit(len(START) + 1), F.char_length(block))
        role = F.substring_index(content, "\n", 1)
        body = F.substring(content, F.char_length(role) + 2, F.char_length(content))
        return F.transform(
            F.split(body, r"<\|im_sep\|>", -1),
            lambda text: F.struct(unescaped_role(role).alias("role"), unescaped(text).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def chat_digest(parts: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What is read back from the parts of `formatted_chat`, one row for each conversation.

    sha256 has no partial form, so here, and only here, a conversation is one string.
    """
    loss = F.array_join(
        F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), ""
    )
    whole = (
        parts.withColumn("_loss", loss)
        .groupBy(conv_col)
        .agg(F.sort_array(F.collect_list(F.struct("part", "piece", "formatted", "_loss"))).alias("parts"))
        .select(
            conv_col,
            F.array_join(F.transform("parts", lambda p: p["formatted"]), "").alias("formatted"),
            F.array_join(F.transform("parts", lambda p: p["_loss"]), "").alias("loss"),
        )
        .withColumn("turns", read_back(F.col("formatted")))
    )
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return whole.select(
        conv_col,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(text, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold another template's control strings."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    planted = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", planted), (-7, 1, "assistant", planted)], "conv_id long, turn long, role string, text string")
    return chat_digest(formatted_chat(turns.unionByName(more)))


OP3_SQL = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *,
    length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS text_len,
    length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '<\~')) AS role_len,
    coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) = role, false) AS same
  FROM rows_
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(text_len + CASE WHEN same THEN 10 ELSE role_len + 12 + 1 + 11 END) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""
