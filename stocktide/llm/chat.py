"""Reply trees to chat-formatted conversations, with DataFrame functions only.

Messages point to the message they answer. Self-joins that double their reach enumerate the path from every leaf to
its root (a path of n messages takes about log2 n joins), branches are ranked by score, and each chosen path is written
as one conversation: ``<turn>role<text>text</turn>`` and a line end per message. Control strings inside roles and texts
are escaped with a backslash, and backslashes are doubled, so the texts can be read back exactly.

All joins sort and merge: a broadcast by (tree, node) would set aside a page of up to 64 MB on the driver and on every executor, however
few rows it has, and there is one per join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.llm.worker import renamed
from stocktide.storage import staged

OPEN, MIDDLE, CLOSE = "<turn>", "<text>", "</turn>\n"
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in (OPEN, MIDDLE, CLOSE.strip()):
        text = F.replace(text, F.lit(control), F.lit(f"<\\{control[1:]}"))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def paths(messages: DataFrame) -> DataFrame:
    """All (tree, leaf, node, up) of messages (tree, node, parent): ``up`` steps lead from the leaf to the node.

    Each round doubles the reach: pairs found so far and pointers of 1, 2, 4, ... steps are joined with the pointers, in one join.
    A message whose parent is missing starts its path.
    """
    nodes = messages.select("tree", "node")
    jump = staged(
        messages.select("tree", F.col("node").alias("leaf"), F.col("parent").alias("node"), F.lit(None).cast("long").alias("up"))
        .join(nodes.hint("merge"), ["tree", "node"], "left_semi").select("tree", "leaf", "node", "up")
    )
    parents = jump.select("tree", "node").distinct()
    ends = nodes.join(parents.hint("merge"), ["tree", "node"], "left_anti")
    found = staged(ends.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")).unionAll(jump))
    step = 1
    while True:
        jump = found.filter("up IS NULL").select("tree", F.col("leaf").alias("node"), F.col("node").alias("above"))
        if jump.isEmpty():
            return found.filter("up IS NOT NULL")
        further = found.join(jump.hint("merge"), ["tree", "node"]).select("tree", "leaf", F.col("above").alias("node"), (F.col("up") + step).alias("up"))
        found = staged(found.filter("up IS NOT NULL").unionAll(further))
        step *= 2


def chat_format(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """Format the ``branches`` best paths of every tree (NULL: all) of messages (tree, node, parent, role, text, score).

    ``node`` must not be NULL, and no message may answer itself over a circle; messages without a ``tree`` are one tree. A branch scores the mean
    of its messages (NULL scores count 0); ties go to the smaller leaf. Returns tree, leaf, branch (rank from 1), formatted,
    and loss_spans: code point positions [start, stop) of the assistant's texts in it. NULL roles and texts count
    as empty. Empty tables give an empty result; other columns are ignored.
    """
    messages = messages.withColumn("tree", F.struct(F.col("tree").alias("id")))  # a key that joins where the id is NULL
    pairs = paths(messages)
    scored = pairs.join(messages.select("tree", "node", F.coalesce("score", F.lit(0)).alias("score")).hint("merge"), ["tree", "node"])
    best = scored.groupBy("tree", "leaf").agg(F.avg("score").alias("score")).select(
        "tree", "leaf", F.expr("row_number() OVER (PARTITION BY tree ORDER BY score DESC, leaf)").alias("branch")
    )
    best = staged(best if branches is None else best.filter(F.col("branch") <= branches))
    if branches is not None:
        pairs = pairs.join(best.hint("merge"), ["tree", "leaf"], "left_semi")
    empty = F.lit("")
    turn = F.struct((-F.col("up")).alias("at"), F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    turns = pairs.join(messages.select("tree", "node", "role", "text").hint("merge"), ["tree", "node"]).groupBy("tree", "leaf").agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    ).join(best.hint("merge"), ["tree", "leaf"])
    parts = turns.select("tree", "leaf", "branch", F.transform("turns", lambda t: F.struct(
        (t["role"] == LEARNED).alias("learned"),
        F.concat(F.lit(OPEN), escaped(t["role"]), F.lit(MIDDLE)).alias("head"),
        escaped(t["text"]).alias("body"),
    )).alias("parts"))
    spans = F.aggregate(
        "parts", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans")),
        lambda s, p: F.struct(
            (s["at"] + F.length(p["head"]) + F.length(p["body"]) + len(CLOSE)).alias("at"),
            F.when(p["learned"], F.concat(s["spans"], F.array(F.struct(
                (s["at"] + F.length(p["head"])).alias("start"),
                (s["at"] + F.length(p["head"]) + F.length(p["body"])).alias("stop"),
            )))).otherwise(s["spans"]).alias("spans"),
        ),
    )["spans"]
    lines = F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE)))
    return parts.select(F.col("tree.id").alias("tree"), "leaf", "branch", F.array_join(lines, "").alias("formatted"), spans.alias("loss_spans"))


def parsed(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    turns = F.split(formatted, CLOSE)
    return F.transform(F.slice(turns, 1, F.size(turns) - 1), lambda t: F.struct(
        unescaped(F.substring_index(F.substr(t, F.lit(len(OPEN) + 1)), MIDDLE, 1)).alias("role"),
        unescaped(F.substr(t, F.locate(MIDDLE, t) + len(MIDDLE))).alias("text"),
    ))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substr(formatted, s["start"] + 1, s["stop"] - s["start"]))), "")


def chains(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows of linear conversations as messages: each answers the one before. Ties in ``turn`` go by role, then text.

    Rows without a ``conv`` are one conversation.
    """
    at = F.expr("row_number() OVER (PARTITION BY tree ORDER BY turn, role, text)").cast("long")
    return renamed(rows, tree=conv, turn=turn, role=role, text=text).select(
        "tree", at.alias("node"), (at - 1).alias("parent"), "role", "text", F.length("text").alias("score")
    )


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "\\### Assistant: </turn> ok"
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], rows.schema)
    made = chat_format(staged(chains(rows.unionAll(extra))))
    turns = parsed(F.col("formatted"))
    said = F.array_join(F.transform(F.col("turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return made.withColumn("turns", turns).withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans"))).select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _sql_escaped(column: str) -> str:
    text = f"replace({column}, '\\', '\\\\')"
    for control in (OPEN, MIDDLE, CLOSE.strip()):
        text = f"replace({text}, '{control}', '<\\{control[1:]}')"
    return text


OP9_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{LEARNED}'), '') AS loss,
         sum({len(OPEN + MIDDLE + CLOSE)} + length({_sql_escaped('role')}) + length({_sql_escaped('text')}))::BIGINT AS formatted_chars
  FROM t GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
"""
