"""Deeply nested records into related flat tables by interval labels.

A depth-first traversal numbers everything in a record on entry (``pre``) and on
exit (``post``) from one counter: a mapping node, then its message, the parts and
the attachments of that, then the nodes below. One thing lies inside another
exactly if its interval lies inside the other's, whatever tables they are in.
Damaged records are no trees: a link that the traversal could not use (second
parent, cycle) is kept as a cross link, so no stated link is lost.

Rows of all tables name the version of the record they come from: ``rec`` is a
fingerprint of the whole mapping, ``version`` the first time it was exported. A
record that was exported again unchanged gives its rows once, a changed one gives
them again under its own version.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABELS = pa.schema([("conv_no", pa.int64()), ("rec", pa.int64()), ("node_id", pa.string()), ("pre", pa.int32()), ("post", pa.int32()), ("depth", pa.int32()), ("parent_pre", pa.int32()), ("cross_parents", pa.list_(pa.int32()))])
LABELS_DDL = "conv_no long, rec long, node_id string, pre int, post int, depth int, parent_pre int, cross_parents array<int>"


def interval_labels(names: list[str], parents: list[str | None], children: list[list[str | None] | None], inner: list[int] | None = None) -> list[tuple]:
    """(name, pre, post, depth, parent_pre or None, pres of other stated parents) of every node.

    ``inner`` are the numbers each node needs for what it holds besides nodes;
    they follow its entry. Roots are the nodes no link leads to, in the order given; what is reachable
    from none of them lies on cycles and is entered at its first node.
    Iterative, so depth is bounded by memory alone.
    """
    below: dict[str, dict[str, None]] = {n: {} for n in names}
    has_parent = set()
    for n, p, kids in zip(names, parents, children):
        if p in below and p != n:
            below[p][n] = None
            has_parent.add(n)
        for k in kids or ():
            if k in below and k != n:
                below[n][k] = None
                has_parent.add(k)
    pre: dict[str, int] = {}
    post: dict[str, int] = {}
    depth: dict[str, int] = {}
    tree: dict[str, str] = {}
    room = dict(zip(names, inner or [0] * len(names)))
    clock = 0
    for start in [n for n in names if n not in has_parent] + names:
        if start in pre:
            continue
        pre[start], depth[start], clock = clock, 0, clock + 1 + room[start]
        stack = [(start, iter(below[start]))]
        while stack:
            node, rest = stack[-1]
            for kid in rest:
                if kid not in pre:
                    pre[kid], depth[kid], tree[kid], clock = clock, len(stack), node, clock + 1 + room[kid]
                    stack.append((kid, iter(below[kid])))
                    break
            else:
                post[node], clock = clock, clock + 1
                stack.pop()
    cross: dict[str, list[int]] = {}
    for n, kids in below.items():
        for k in kids:
            if tree.get(k) != n:
                cross.setdefault(k, []).append(pre[n])
    return [(n, pre[n], post[n], depth[n], pre[tree[n]] if n in tree else None, cross.get(n, [])) for n in below]


def _label_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for row in batch.to_pylist():
            out += [(row["conv_no"], row["rec"], *x) for x in interval_labels(row["names"] or [], row["parents"] or [], row["children"] or [], row["inner"])]
        yield pa.record_batch([pa.array([r[i] for r in out], type=f.type) for i, f in enumerate(LABELS)], schema=LABELS)


def with_record(df: DataFrame) -> DataFrame:
    """Adds ``rec``: a fingerprint of the whole mapping, null without one. Computed from the row alone: stable under retries."""
    return df.withColumn("rec", F.when(F.col("mapping").isNotNull(), F.xxhash64(F.map_entries("mapping"))))


def _count(items: Column) -> Column:
    return F.coalesce(F.greatest(F.size(items), F.lit(0)), F.lit(0))


def _inner(message: Column) -> Column:
    """Numbers a node needs for its message: two for the message, each part and each attachment."""
    held = _count(message["content"]["parts"]) + _count(message["metadata"]["attachments"])
    return F.when(message.isNull(), 0).otherwise(2 + 2 * held).cast("int")


def nodes(conversations: DataFrame) -> DataFrame:
    """Node table: one row per mapping node with its interval labels.

    A node is named by its map key. Null and empty mappings give no rows; a node
    whose value is null is a node without links. Repeated records give their
    nodes once. Only names, links and counts travel to Python.
    """
    entries = F.map_entries("mapping")
    slim = with_record(conversations.select("conv_no", "mapping")).where("mapping is not null").select(
        "conv_no", "rec", F.transform(entries, lambda e: e["key"]).alias("names"), F.transform(entries, lambda e: e["value"]["parent"]).alias("parents"), F.transform(entries, lambda e: e["value"]["children"]).alias("children"),
        F.transform(entries, lambda e: _inner(e["value"]["message"])).alias("inner"),
    ).dropDuplicates(["conv_no", "rec"])
    return slim.mapInArrow(_label_batches, LABELS_DDL)


def links(node_table: DataFrame) -> DataFrame:
    """(conv_no, rec, parent_id, child_id): tree links by the containing interval, and cross links.

    The parent of a node is the tightest interval that contains its own; its
    entry number rides on the child, so containment is an equi-join on
    (conv_no, rec, pre) with the containment test as residual, not a range join.
    """
    up = F.concat(F.transform(F.array_compact(F.array("parent_pre")), lambda p: F.struct(p.alias("at"), F.lit(True).alias("inside"))), F.transform("cross_parents", lambda p: F.struct(p.alias("at"), F.lit(False).alias("inside"))))
    child = node_table.select("conv_no", "rec", F.col("node_id").alias("child_id"), F.col("pre").alias("c_pre"), F.col("post").alias("c_post"), F.explode(up).alias("up")).select("*", "up.at", "up.inside")
    parent = node_table.select("conv_no", "rec", F.col("node_id").alias("parent_id"), F.col("pre").alias("p_pre"), F.col("post").alias("p_post"))
    inside = ~F.col("inside") | ((F.col("p_pre") < F.col("c_pre")) & (F.col("c_post") < F.col("p_post")))
    null_safe = child.conv_no.eqNullSafe(parent.conv_no) & (child.rec == parent.rec) & (child["at"] == parent["p_pre"])
    return child.join(parent, null_safe).where(inside).select(child.conv_no, child.rec, "parent_id", "child_id").distinct()


def versions(conversations: DataFrame) -> DataFrame:
    """(conv_no, rec, version, mapping) of every distinct mapping; version is its first exported_at."""
    rows = with_record(conversations.select("conv_no", "mapping", "exported_at")).where("mapping is not null")
    return rows.groupBy("conv_no", "rec").agg(F.min("exported_at").alias("version"), F.first("mapping").alias("mapping"))


def messages(conversations: DataFrame, node_table: DataFrame | None = None) -> DataFrame:
    """Message table: one row per node with a message. ``up`` is the entry number of the node that holds it."""
    labels = (nodes(conversations) if node_table is None else node_table).select(F.col("conv_no").alias("_c"), F.col("rec").alias("_r"), F.col("node_id").alias("_n"), F.col("pre").alias("up"))
    rows = versions(conversations).select("conv_no", "rec", "version", F.explode("mapping").alias("node_id", "node")).where("node.message is not null")
    m = F.col("node.message")
    same = F.col("conv_no").eqNullSafe(F.col("_c")) & (F.col("rec") == F.col("_r")) & (F.col("node_id") == F.col("_n"))
    return rows.join(labels, same).select(
        "conv_no", "rec", "version", (F.col("up") + 1).alias("pre"), (F.col("up") + _inner(m)).alias("post"), "up", m["id"].alias("message_id"), m["author"]["role"].alias("role"), m["create_time"].alias("create_time"), m["content"]["content_type"].alias("content_type"),
        m["metadata"]["is_visually_hidden_from_conversation"].alias("hidden"), F.size(m["content"]["parts"]).alias("n_parts"), m["content"]["parts"].alias("parts"), m["metadata"]["attachments"].alias("attachments"),
    )


def parts(message_table: DataFrame) -> DataFrame:
    """Part table: one row per element of a message's parts, null elements included. ``up`` is the entry number of the message."""
    rows = message_table.select("conv_no", "rec", "version", F.col("pre").alias("up"), F.posexplode("parts").alias("part_no", "part"))
    first = F.col("up") + 1 + 2 * F.col("part_no")
    return rows.select("conv_no", "rec", "version", first.alias("pre"), (first + 1).alias("post"), "up", "part_no", "part")


def attachments(message_table: DataFrame) -> DataFrame:
    """Attachment table: they are numbered behind the parts of their message."""
    rows = message_table.select("conv_no", "rec", "version", F.col("pre").alias("up"), _count(F.col("parts")).alias("n"), F.posexplode("attachments").alias("attachment_no", "a"))
    first = F.col("up") + 1 + 2 * (F.col("n") + F.col("attachment_no"))
    return rows.select("conv_no", "rec", "version", first.alias("pre"), (first + 1).alias("post"), "up", "attachment_no", F.col("a.id").alias("attachment_id"), F.col("a.mime").alias("mime"), F.col("a.size").alias("size"))


def within(child: DataFrame, parent: DataFrame, columns: list[str]) -> DataFrame:
    """child with columns of the row of ``parent`` whose interval holds its own most tightly.

    The entry number of that row rides on the child as ``up``, so containment is
    an equi-join with the test of both ends as residual.
    """
    p = parent.select(F.col("conv_no").alias("_c"), F.col("rec").alias("_r"), F.col("pre").alias("_pre"), F.col("post").alias("_post"), *columns)
    same = F.col("conv_no").eqNullSafe(F.col("_c")) & (F.col("rec") == F.col("_r")) & (F.col("up") == F.col("_pre"))
    return child.join(p, same & (F.col("_pre") < F.col("pre")) & (F.col("post") < F.col("_post"))).drop("_c", "_r", "_pre", "_post")


def records(conversations: DataFrame) -> DataFrame:
    """Conversation table, one row per distinct export row; id stands in for a missing conversation_id."""
    return with_record(conversations).select("conv_no", "rec", F.coalesce(F.nullif("conversation_id", F.lit("")), "id").alias("conversation_id"), "title", "create_time", "current_node", F.coalesce(F.size("mapping"), F.lit(0)).alias("n_nodes"), "exported_at").distinct()
