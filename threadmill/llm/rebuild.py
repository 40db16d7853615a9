"""Rebuilding conversations from message rows.

Reply links form a graph in which every row has at most one parent. So each
connected component has exactly one end: a root (null parent), a parent that is
no row, or a cycle. A conversation is broken exactly if the component of its
start has no root. Components are found by alternating large-star and small-star
joins. Before that, links are contracted inside blocks of BLOCK neighbouring
positions of one conversation, so only links between blocks are shuffled again
and again, and a conversation that holds a third of all rows is spread over many
tasks instead of gathered in one.

Rows without conversation_id get one first: the components of their reply links
(and quote links, if a column names them) are conversations; a component that
touches a row with an identifier takes that.

Cases: rows delivered twice count once, the latest delivery. Rows without
node_id are ignored. Two rows of one node_id in one conversation are one node.
A conversation whose rows are all named as parents (cycles only) and that has no
usable current_node is broken. Heads without conversation_id are ignored; of
several heads of one conversation the latest counts. Empty tables give empty
results.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.functions.text import part_text_column
from threadmill.session import cut

BLOCK = 2048
TURN_TYPES = ("text", "multimodal_text")


# -- connected components ------------------------------------------------------


def _fingerprint(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40)).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, component): component is the least node of it. edges has u and v of one type.

    Alternates large-star (each node's larger neighbours to its least neighbour)
    and small-star (its smaller neighbours and itself to the least) until the
    edges stay the same, however many rounds that takes. Minima are combined
    before the shuffle.
    """
    now = cut(edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _fingerprint(now)
    while mark[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        now = cut(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        after = _fingerprint(now)
        if after == mark:
            break
        mark = after
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def identify(messages: DataFrame, quotes: str | None = None) -> DataFrame:
    """Gives rows without conversation_id the one of their component, or its least node_id."""
    known = F.nullif("conversation_id", F.lit("")).isNotNull()
    lacking = messages.where(~known)
    if lacking.isEmpty():
        return messages
    links = lacking.select(F.col("node_id").alias("u"), F.col("parent").alias("v"))
    if quotes:
        links = links.union(lacking.select(F.col("node_id").alias("u"), F.col(quotes).alias("v")))
    found = components(links)
    owner = messages.where(known).select(F.col("node_id").alias("node"), "conversation_id").join(found, "node").groupBy("component").agg(F.min("conversation_id").alias("_owner"))
    label = found.join(owner, "component", "left").select("node", F.coalesce("_owner", "component").alias("_label"))
    named = lacking.join(label, lacking.node_id == label.node, "left").withColumn("conversation_id", F.coalesce("_label", "node_id")).drop("node", "_label")
    return messages.where(known).unionByName(named)


#: A part of this many characters that stands in another message too is a quotation of it.
QUOTED = 240


def quote_links(messages: DataFrame, least: int = QUOTED) -> DataFrame:
    """(u, v): nodes and the first one (least node_id) that holds one of their long parts word for word."""
    text = messages.where("node_id is not null").select("node_id", F.explode("parts").alias("part")).select("node_id", part_text_column(F.col("part")).alias("text")).where(F.length("text") >= least)
    held = text.select("node_id", F.xxhash64("text").alias("h"), F.xxhash64(F.lit("2"), "text").alias("h2")).distinct()
    # the minimum is combined before the shuffle, so a part that many messages hold is one row a task
    first = held.groupBy("h", "h2").agg(F.min("node_id").alias("v"), F.count("*").alias("n")).where("n > 1").drop("n")
    return held.join(first, ["h", "h2"]).where("node_id <> v").select(F.col("node_id").alias("u"), "v")


def identified(messages: DataFrame) -> DataFrame:
    """(node_id, conversation): the component of every node over reply and quote links, whatever identifiers the rows have."""
    rows = messages.where("node_id is not null")
    links = rows.select(F.col("node_id").alias("u"), F.col("parent").alias("v")).union(quote_links(messages))
    found = components(links)
    return rows.select("node_id").distinct().join(found, F.col("node_id") == F.col("node"), "left").select("node_id", F.coalesce("component", "node_id").alias("conversation"))


# -- contraction inside blocks -------------------------------------------------

LOCAL = pa.schema([("conversation_id", pa.string()), ("block", pa.int64()), ("node_id", pa.string()), ("node_pos", pa.int32()), ("parent", pa.string()), ("turn", pa.string()), ("kind", pa.string()), ("top", pa.string()), ("exit_to", pa.string()), ("hops", pa.int32()), ("last_turn", pa.string()), ("unnamed", pa.bool_())])
LOCAL_DDL = "conversation_id string, block long, node_id string, node_pos int, parent string, turn string, kind string, top string, exit_to string, hops int, last_turn string, unnamed boolean"


def solve_block(ids: list[str], parents: list[str | None], turns: list[str | None]) -> tuple[list, ...]:
    """For each row, following parents inside the block: how the way ends ('root', 'exit' or 'cycle'), the last row, the hops to it, and the nearest turn at or above."""
    n = len(ids)
    at = {x: i for i, x in enumerate(ids)}
    up = [at.get(p, -1) if p is not None else -1 for p in parents]
    kind: list[str | None] = [None] * n
    top, hops, last = [0] * n, [0] * n, [None] * n
    busy = [False] * n
    for i in range(n):
        way = []
        j = i
        while j >= 0 and kind[j] is None and not busy[j]:
            busy[j] = True
            way.append(j)
            j = up[j]
        if not way:
            continue
        if j >= 0 and kind[j] is None:  # the way met itself
            for k in way:
                kind[k], top[k], last[k] = "cycle", j, turns[k]
        else:
            k = way.pop()
            if up[k] < 0:
                kind[k], top[k], last[k] = ("root" if parents[k] is None else "exit"), k, turns[k]
            else:
                way.append(k)
            for k in reversed(way):
                u = up[k]
                kind[k], top[k], hops[k], last[k] = kind[u], top[u], hops[u] + 1, turns[k] or last[u]
    return kind, top, hops, last


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: list[list] = [[] for _ in LOCAL]
        for conv, block, ids, pos, parents, turns in zip(*(batch.column(i).to_pylist() for i in range(6))):
            kind, top, hops, last = solve_block(ids, parents, turns)
            named = set(parents)
            values = ([conv] * len(ids), [block] * len(ids), ids, pos, parents, turns, kind, [ids[t] for t in top], [parents[t] if k == "exit" else None for t, k in zip(top, kind)], hops, last, [x not in named for x in ids])
            for c, v in zip(columns, values):
                c.extend(v)
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, LOCAL)], schema=LOCAL)


def turn_kind() -> Column:
    """'user' or 'assistant' if the row is a turn, else null."""
    role = F.lower(F.trim("role"))
    text = F.exists("parts", lambda p: part_text_column(p).rlike(r"(?U)\S"))
    return F.when(role.isin("user", "assistant") & ~F.coalesce("hidden", F.lit(False)) & F.col("content_type").isin(*TURN_TYPES) & F.coalesce(text, F.lit(False)), role)


def local_links(messages: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every row once, with what its block alone says about its way to the root. Texts aren't shuffled."""
    slim = messages.where("node_id is not null and conversation_id is not null").select("conversation_id", "node_id", "ingested_at", F.col("node_pos").cast("int"), "parent", turn_kind().alias("turn"))
    last = F.max(F.struct("ingested_at", "node_pos", "parent", "turn")).alias("r")
    once = slim.groupBy("conversation_id", "node_id").agg(last).select("conversation_id", "node_id", "r.*")
    # rows without a position are spread by hash; neighbours in position are mostly neighbours by reply
    place = F.coalesce(F.floor(F.col("node_pos") / block), -1 - F.pmod(F.xxhash64("node_id"), F.lit(1024)))
    rows = once.groupBy("conversation_id", place.alias("block")).agg(F.collect_list(F.struct("node_id", "node_pos", "parent", "turn")).alias("rows"))
    return rows.select("conversation_id", "block", "rows.node_id", "rows.node_pos", "rows.parent", "rows.turn").mapInArrow(_local, LOCAL_DDL)


# -- paths ----------------------------------------------------------------------


def _heads(heads: DataFrame) -> DataFrame:
    latest = F.max(F.struct("exported_at", "current_node")).alias("h")
    return heads.where("conversation_id is not null").groupBy("conversation_id").agg(latest).select("conversation_id", "h.current_node")


class Rebuilt:
    """The steps of a rebuild, each a DataFrame: ``starts`` (one row a conversation with rows), ``verdicts``, ``turns``."""

    def __init__(self, messages: DataFrame, heads: DataFrame, block: int = BLOCK, quotes: str | None = None):
        self.messages = identify(messages, quotes)
        self.heads = _heads(heads)
        self.local = cut(local_links(self.messages, block))
        local = self.local
        tops = local.where("kind = 'exit' and node_id = top").select("conversation_id", F.col("node_id").alias("from_top"), "exit_to")
        self.exits = tops.select("conversation_id", "exit_to").distinct()
        entry = local.select("conversation_id", F.col("node_id").alias("exit_to"), F.col("top").alias("to_top"), "kind", "last_turn", "hops", F.col("exit_to").alias("next"))
        # where ways out of blocks lead: nothing, if the parent is no row
        self.entries = cut(self.exits.join(entry, ["conversation_id", "exit_to"]))
        self.edges = tops.join(self.entries.select("conversation_id", "exit_to", "to_top"), ["conversation_id", "exit_to"])
        self.starts = cut(self._starts())
        self.rooted = cut(self._rooted())
        # starts whose way ends at a root
        self.whole = self.starts.join(self.rooted, ["conversation_id", "top"], "left_semi")
        self.steps: DataFrame | None = None

    def _starts(self) -> DataFrame:
        local = self.local.select("conversation_id", "node_id", "node_pos", "block", "kind", "top", "exit_to", "hops", "last_turn", "unnamed")
        given = self.heads.join(local.withColumnRenamed("node_id", "current_node"), ["conversation_id", "current_node"]).withColumnRenamed("current_node", "node_id")
        leaves = local.where("unnamed").join(given.select("conversation_id"), "conversation_id", "left_anti").join(self.exits.withColumnRenamed("exit_to", "node_id"), ["conversation_id", "node_id"], "left_anti")
        best = leaves.groupBy("conversation_id").agg(F.max(F.struct(*[c for c in ("node_pos", "node_id", "block", "kind", "top", "exit_to", "hops", "last_turn")])).alias("r")).select("conversation_id", "r.*")
        columns = ["conversation_id", "node_id", "block", "kind", "top", "exit_to", "hops", "last_turn"]
        return given.select(columns).unionByName(best.select(columns))

    def _rooted(self) -> DataFrame:
        """(conversation_id, top) of block-wise ways whose component has a root."""
        name = lambda c: F.concat_ws("\u0001", "conversation_id", c)
        found = components(self.edges.select(name("from_top").alias("u"), name("to_top").alias("v")))
        roots = self.local.where("kind = 'root' and node_id = top").select(name("top").alias("node"), "conversation_id", "top")
        # ways that stay in their block are their own component
        whole = found.join(roots.select("node"), "node", "left_semi").select("component").distinct()
        reached = found.join(whole, "component", "left_semi").select("node")
        split = F.split("node", "\u0001")
        return reached.select(split[0].alias("conversation_id"), split[1].alias("top")).unionByName(roots.select("conversation_id", "top")).distinct()

    def _jumps(self) -> DataFrame:
        """Steps between blocks on ways that end at a root, so every chain of them ends. Found once."""
        if self.steps is None:
            self.steps = cut(self._found_jumps())
        return self.steps

    def _found_jumps(self) -> DataFrame:
        ending = self.entries.join(self.rooted.withColumnRenamed("top", "to_top"), ["conversation_id", "to_top"], "left_semi")
        return ending.select("conversation_id", F.col("exit_to").alias("entry"), "next", "last_turn", (F.col("hops") + 1).cast("long").alias("far"))

    def last_turns(self) -> DataFrame:
        """(conversation_id, last_turn): the nearest turn at or above the start, across blocks by pointer doubling."""
        whole = self.whole
        done = whole.where("last_turn is not null or kind <> 'exit'").select("conversation_id", "last_turn")
        open_ = whole.where("last_turn is null and kind = 'exit'").select("conversation_id", F.col("exit_to").alias("entry"))
        jumps = self._jumps().drop("far")
        while True:  # ways that end at a root are finite, and each round doubles what is jumped
            open_ = cut(open_)
            if open_.isEmpty():
                break
            step = open_.join(jumps, ["conversation_id", "entry"], "left")
            done = done.unionByName(step.where("last_turn is not null or next is null").select("conversation_id", "last_turn"))
            open_ = step.where("last_turn is null and next is not null").select("conversation_id", F.col("next").alias("entry"))
            ahead = jumps.select("conversation_id", F.col("entry").alias("next"), F.col("next").alias("next2"), F.col("last_turn").alias("turn2"))
            jumps = cut(jumps.join(ahead, ["conversation_id", "next"], "left").select("conversation_id", "entry", F.when(F.col("last_turn").isNull(), F.col("next2")).alias("next"), F.coalesce("last_turn", "turn2").alias("last_turn")))
        return done

    def verdicts(self) -> DataFrame:
        """(conversation_id, reason) of every head: null for a whole conversation with a reply."""
        starts = self.starts.join(self.rooted.withColumn("ok", F.lit(True)), ["conversation_id", "top"], "left").select("conversation_id", "ok")
        present = self.local.select("conversation_id").distinct().withColumn("present", F.lit(True))
        all_ = self.heads.select("conversation_id").join(present, "conversation_id", "left").join(starts, "conversation_id", "left").join(self.last_turns(), "conversation_id", "left")
        reason = F.when(F.col("present").isNull(), "empty").when(F.col("ok").isNull(), "broken").when(F.col("last_turn").isNull(), "empty").when(F.col("last_turn") == "user", "no_reply")
        return all_.select("conversation_id", reason.alias("reason"))

    def path_entries(self) -> DataFrame:
        """(conversation_id, entry, base): the rows by which the path enters its blocks, with their distance from the start."""
        whole = self.whole
        marks = whole.select("conversation_id", F.col("node_id").alias("entry"), F.lit(0).cast("long").alias("base"))
        own = whole.where("kind = 'exit'").select("conversation_id", F.col("node_id").alias("entry"), F.col("exit_to").alias("next"), (F.col("hops") + 1).cast("long").alias("far"))
        # a start may be an entry too: one row each
        jumps = cut(self._jumps().select("conversation_id", "entry", "next", "far").where("next is not null").unionByName(own).distinct())
        while not jumps.isEmpty():
            new = marks.join(jumps, ["conversation_id", "entry"]).select("conversation_id", F.col("next").alias("entry"), (F.col("base") + F.col("far")).alias("base"))
            marks = cut(marks.unionByName(new).groupBy("conversation_id", "entry").agg(F.min("base").alias("base")))
            ahead = jumps.select("conversation_id", F.col("entry").alias("next"), F.col("next").alias("next2"), F.col("far").alias("far2"))
            jumps = cut(jumps.join(ahead, ["conversation_id", "next"]).select("conversation_id", "entry", F.col("next2").alias("next"), (F.col("far") + F.col("far2")).alias("far")))
        return marks

    def turns(self) -> DataFrame:
        """(conversation_id, turn_no, node_id, role, text): the kept conversations, in order from the root."""
        kept = self.verdicts().where("reason is null").select("conversation_id")
        entries = self.path_entries().join(kept, "conversation_id", "left_semi").join(self.local.select("conversation_id", F.col("node_id").alias("entry"), "block"), ["conversation_id", "entry"])
        entries = entries.groupBy("conversation_id", "block").agg(F.collect_list(F.struct("entry", "base")).alias("entries"))
        rows = self.local.groupBy("conversation_id", "block").agg(F.collect_list(F.struct("node_id", "parent", "turn")).alias("rows"))
        walked = rows.join(entries, ["conversation_id", "block"]).select("conversation_id", "rows.node_id", "rows.parent", "rows.turn", "entries.entry", "entries.base").mapInArrow(_walk, "conversation_id string, node_id string, role string, distance long")
        text = F.array_join(F.filter(F.transform("parts", part_text_column), lambda t: t.rlike(r"(?U)\S")), "\n")
        texts = self.messages.where(turn_kind().isNotNull()).groupBy("conversation_id", "node_id").agg(F.max_by(text, "ingested_at").alias("text"))
        # the place of a turn: distances are distinct along a path, so it is the count of turns farther from the start;
        # conversations are long at most in one key, so turns are numbered within blocks of the distance first
        return number_turns(walked).join(texts, ["conversation_id", "node_id"])


def number_turns(walked: DataFrame, width: int = BLOCK) -> DataFrame:
    """turn_no from 0 at the root: the turns in farther stretches of ``width``, plus those farther within the stretch."""
    from pyspark.sql import Window

    cell = walked.withColumn("stretch", F.floor(F.col("distance") / width))
    sizes = cell.groupBy("conversation_id", "stretch").agg(F.count("*").alias("n"))
    before = sizes.select("conversation_id", "stretch", (F.sum("n").over(Window.partitionBy("conversation_id").orderBy(F.desc("stretch"))) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("conversation_id", "stretch").orderBy(F.desc("distance"))) - 1
    return cell.withColumn("place", place).join(before, ["conversation_id", "stretch"]).select("conversation_id", (F.col("before") + F.col("place")).cast("long").alias("turn_no"), "node_id", "role")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for conv, ids, parents, turns, entries, bases in zip(*(batch.column(i).to_pylist() for i in range(6))):
            up, turn, seen = dict(zip(ids, parents)), dict(zip(ids, turns)), set()
            for node, far in sorted(zip(entries, bases), key=lambda x: x[1]):
                while node in up and node not in seen:
                    seen.add(node)
                    if turn[node]:
                        out.append((conv, node, turn[node], far))
                    node, far = up[node], far + 1
        yield pa.record_batch({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate((("conversation_id", pa.string()), ("node_id", pa.string()), ("role", pa.string()), ("distance", pa.int64())))})


def dropped(messages: DataFrame, heads: DataFrame, block: int = BLOCK) -> DataFrame:
    return Rebuilt(messages, heads, block).verdicts().where("reason is not null")
