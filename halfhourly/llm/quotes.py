"""Quotation linking: reply-ordered conversations without their quotes.

A message's lines are parsed into quote levels (runs of ``>``); attribution lines before a quote go
with it.  Quoted passages are joined per level, cut into sentences, normalised (lower
case, words only) and hashed, so re-wrapped quotes still match.  The hashes are joined to the
sentences that messages say themselves: first inside the conversation, and what
finds nothing there to the earliest message of all conversations before it.  Both sides of a join
have one row a key (the earliest speaker), so a sentence said by a third of all
messages stays linear.

A message replies to the one that most of its outermost quoted sentences come from (ties: the
latest); without a resolved quote to the previous turn.  Parents are always earlier
in (conv_id, turn), so there are no cycles.  Thread roots and depths come from pointer
doubling, log2(depth) joins on unique keys; no conversation is gathered in a task.

Defined cases: null text: empty body, no quotes; a quote without a source: no link; null conv_id or turn:
a message of its own, without parent; repeated rows (same conv_id and turn): one node, a row
each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halfhourly.llm.common import materialize, rebatch

_MARK = re.compile(r"^((?:[ \t]*>)+)[ \t]?")
_ATTRIBUTION = re.compile(r"^\s*(on\b.*\bwrote|.{0,80}\b(?:wrote|writes|said|schrieb|escribió|a écrit))\s*:\s*$", re.I)
_SENTENCE = re.compile(r"[.!?]+")
_WORD = re.compile(r"\w+")
_PARSED = ("conv_id long, turn long, role string, body string, own array<long>, "
           "quoted array<struct<level: int, h: long>>")


def sentence_hashes(text: str) -> list[int]:
    out = []
    for part in _SENTENCE.split(text):
        words = _WORD.findall(part.lower())
        if words:
            out.append(xxhash.xxh3_64_intdigest(" ".join(words).encode("utf-8", "surrogatepass")) - (1 << 63))
    return out


def parse(text: str | None) -> tuple[str, list[int], list[tuple[int, int]]]:
    """(text without quotes, hashes of its sentences, (level, hash) of the quoted sentences)."""
    body: list[str] = []
    levels: dict[int, list[str]] = {}
    lines = (text or "").split("\n")
    for i, line in enumerate(lines):
        m = _MARK.match(line)
        if m:
            levels.setdefault(m[1].count(">"), []).append(line[m.end():])
        elif not (_ATTRIBUTION.match(line) and i + 1 < len(lines) and _MARK.match(lines[i + 1])):
            body.append(line)
    own = "\n".join(body).strip("\n") if levels else (text or "")
    return own, sentence_hashes(own.replace("\n", " ")), [
        (level, h) for level, part in sorted(levels.items()) for h in sentence_hashes(" ".join(part))]


def _parse(it):
    for pdf in rebatch(it, "text"):
        rows = [parse(t) for t in pdf["text"]]
        yield pd.DataFrame({
            "conv_id": pdf["conv_id"].astype("Int64"), "turn": pdf["turn"].astype("Int64"), "role": pdf["role"],
            "body": [r[0] for r in rows], "own": [r[1] for r in rows],
            "quoted": [[{"level": a, "h": h} for a, h in r[2]] for r in rows]})


def parents(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, p_conv, p_turn) from quotes: the message that the quoted sentences come from."""
    own = parsed.select("conv_id", "turn", F.explode("own").alias("h")).filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    quoted = parsed.select("conv_id", "turn", F.inline("quoted")).filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    inside = own.groupBy("conv_id", "h").agg(F.min("turn").alias("p_turn"))
    first = own.groupBy("h").agg(F.min(F.struct("conv_id", "turn")).alias("p"))
    near = (quoted.join(inside, ["conv_id", "h"], "left")
            .withColumn("p_turn", F.when(F.col("p_turn") < F.col("turn"), F.col("p_turn"))))
    found = near.filter("p_turn IS NOT NULL").select("conv_id", "turn", "level", F.col("conv_id").alias("p_conv"), "p_turn")
    far = (near.filter("p_turn IS NULL").join(first, "h").filter("p.conv_id < conv_id")
           .select("conv_id", "turn", "level", F.col("p.conv_id").alias("p_conv"), F.col("p.turn").alias("p_turn")))
    votes = found.unionByName(far).groupBy("conv_id", "turn", "level", "p_conv", "p_turn").agg(F.count("*").alias("n"))
    best = F.struct(-F.col("level"), F.col("n"), F.col("p_conv"), F.col("p_turn"))
    return (votes.groupBy("conv_id", "turn").agg(F.max_by(F.struct("p_conv", "p_turn"), best).alias("p"))
            .select("conv_id", "turn", "p.p_conv", "p.p_turn"))


def threads(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(conv_id, turn, p_conv, p_turn, by_quote, root_conv, root_turn, depth) per message key."""
    before = nodes.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("turn").alias("prev"))
    tree = materialize(
        nodes.join(links, ["conv_id", "turn"], "left").join(before, ["conv_id", "turn"], "left")
        .select("conv_id", "turn", F.col("p_conv").isNotNull().alias("by_quote"),
                F.coalesce("p_conv", F.when(F.col("prev").isNotNull(), F.col("conv_id"))).alias("p_conv"),
                F.coalesce("p_turn", "prev").alias("p_turn")), "tree")
    root = F.col("p_conv").isNull()
    at = materialize(tree.select("conv_id", "turn", F.coalesce("p_conv", "conv_id").alias("to_conv"),
                                 F.coalesce("p_turn", "turn").alias("to_turn"),
                                 F.when(root, 0).otherwise(1).cast("long").alias("depth"), root.alias("done")), "pointers")
    while True:  # only messages that have not reached their root take part in a round
        active = at.filter("NOT done")
        if active.isEmpty():
            break
        up = at.select(F.col("conv_id").alias("to_conv"), F.col("turn").alias("to_turn"), F.col("to_conv").alias("next_conv"),
                       F.col("to_turn").alias("next_turn"), F.col("depth").alias("more"), F.col("done").alias("over"))
        step = active.drop("done").join(up, ["to_conv", "to_turn"]).select(
            "conv_id", "turn", F.col("next_conv").alias("to_conv"), F.col("next_turn").alias("to_turn"),
            (F.col("depth") + F.col("more")).alias("depth"), F.col("over").alias("done"))
        at = materialize(at.filter("done").unionByName(step), "pointers")
    at = at.drop("done")
    return tree.join(at.withColumnsRenamed({"to_conv": "root_conv", "to_turn": "root_turn"}), ["conv_id", "turn"])


def link(conversations: DataFrame) -> DataFrame:
    """One row per message, in reply order (root, depth, turn): conv_id, turn, role, text without quotes,
    n_quoted (sentences), parent_conv, parent_turn, by_quote, root_conv, root_turn, depth."""
    parsed = materialize(conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
                         .mapInPandas(_parse, _PARSED), "parsed-messages")
    nodes = parsed.filter("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn").distinct()
    tree = threads(nodes, parents(parsed)).withColumnsRenamed({"conv_id": "c_", "turn": "t_"})
    out = parsed.join(tree, (F.col("conv_id") == F.col("c_")) & (F.col("turn") == F.col("t_")), "left")
    return (out.select("conv_id", "turn", "role", F.col("body").alias("text"), F.size("quoted").cast("long").alias("n_quoted"),
                       F.col("p_conv").alias("parent_conv"), F.col("p_turn").alias("parent_turn"),
                       F.coalesce("by_quote", F.lit(False)).alias("by_quote"),
                       F.coalesce("root_conv", "conv_id").alias("root_conv"), F.coalesce("root_turn", "turn").alias("root_turn"),
                       F.coalesce("depth", F.lit(0)).cast("long").alias("depth"))
            .orderBy("root_conv", "root_turn", "depth", "conv_id", "turn"))
