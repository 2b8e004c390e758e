"""Conversation structure repair: a DuckDB recursive query inside hash-partitioned batches.

A conversation is repaired by the cheapest edits (keep, rerole, delete, insert) after which its roles follow the grammar
``(s?(ua)+)?``. The grammar has four states, so what a stretch of turns does is a small table: for each state before it and
each state behind it the least cost and, among equals, the least audit (the edits' initials). Stretches of at most ``STRETCH``
turns are dealt by a hash to batches; in a batch one recursive query advances by one turn for all of its stretches at
once and keeps the least (cost, audit) of every pair of states. Tables of stretches are elements like turns, so the same
query joins the stretches of a long conversation, level by level: no conversation is one task, and none is
held whole. An audit of one table always ends with an edit that uses a turn up, so that none is a proper prefix of another and
the least of a whole is made of the least of its parts.

Rows come in the order of a conversation by a range shuffle of their keys alone (ids, turns, roles, hashes of texts), equal rows
counted and not repeated. Texts move once, for the digest of the repaired conversation, and are read as a stream behind
the conversation's audit; SHA-256 takes a text from its start, so this stream, and the audit's one cell, are of one conversation each.

Defined cases: nulls are one space, in the damage as in roles and texts (a null turn sorts first and is ignored by ``gaps``); a
null conv_id is a conversation like others; turns that share a number follow by role, then by a hash of the text; a role counts by its
first character, and one without characters is in no grammar; empty texts are blank; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from solidspark.llm.common import stage, stage_frames, unstage

#: Most turns (or tables) that one stretch joins; elements of a batch, about.
STRETCH, BATCH = 256, 20_000
BLANKS = " \t\n\x0b\x0c\r"
#: States: 0 nothing yet, 1 behind system, 2 behind user, 3 behind assistant; 0 and 3 may end.
#: Inserted turns before an edit: from a state, to a state, how many.
_INSERTS = "(values (0, 0, 0), (0, 2, 1), (0, 3, 2), (1, 1, 0), (1, 2, 1), (1, 3, 2), (2, 2, 0), (2, 3, 1), (3, 3, 0), (3, 2, 1), (3, 3, 2)) ins(s, q, k)"
#: What a turn with this initial does when it is kept, and what one does that takes the role that fits.
_KEEPS = "(values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) keeps(q, c, t)"
_REROLES = "(values (0, 2), (1, 2), (2, 3), (3, 2)) reroles(q, t)"

#: Of turns (g, i, c, l, cut): c the initial, l > 0: so many turns that must go, cut: truncated. Elements (g, i, s, t, cost, ext).
EDGES = f"""
    select g, i, s, t, 2 * k + cost cost, repeat('D', greatest(l - 1, 0)) || repeat('I', k) || op ext
    from {_INSERTS} join (
        select g, i, l, q, t, cut cost, 'K' op from turns join {_KEEPS} using (c) where l = 0
        union all select g, i, l, q, t, 2 + cut, 'R' from turns, {_REROLES} where l = 0
        union all select g, i, l, q, q, 3 * greatest(l, 1), 'D' from turns, (values (0), (1), (2), (3)) deletes(q)
    ) edits using (q)"""

#: The table (s, t) of each stretch g: one element more in each recursion, of which only the last is kept for each pair of states.
#: firsts: the states that a stretch may begin in.
REPAIR = """
    with recursive run(g, i, s, t, cost, audit) using key (g, s, t) as (
        select g, 0::bigint, s, s, 0::bigint, '' from firsts
        union
        select g, i, s, t, best.cost, best.ext from (
            select run.g, e.i, run.s, e.t, min({'cost': run.cost + e.cost, 'ext': run.audit || e.ext}) best
            from run join elements e on e.g = run.g and e.i = run.i + 1 and e.s = run.t
            group by run.g, e.i, run.s, e.t))
    select run.g, s, t, cost, audit from run join (select g, max(i) n from elements group by g) using (g) where i = n"""

_FOUND = "conv {id}, seg long, n long, s int, t int, cost long, audit string, illegal long, head string, tail string"


def damaged(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, copies): rows by crc32 of ``conv:turn``, of 20: 0 drops, 1 empties, 2 takes the marks, 3 repeats, 4 sets the role."""
    one = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    code = F.crc32(F.concat(one(id_col), F.lit(":"), one(turn_col)).cast("binary")) % 20
    rows = turns.select(F.col(f"`{id_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"), one(role_col).alias("role"), one(text_col).alias("text"), code.alias("code"))
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.where("code <> 0").select("conv", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("code") == 3, 2).otherwise(1).alias("copies"))


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _in_order() -> list[Column]:
    """Of one conversation."""
    return [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("key").asc()]


def judged(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, key, m, fault, later): different rows, how often each is there, its own fault, and whether it was seen at an earlier turn."""
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    fault = F.when(last == "", "blank").when(~last.isin(".", "!", "?"), "truncated").otherwise("")
    slim = rows.select("conv", "turn", "role", _key(F.col("text")).alias("key"), "copies", fault.alias("fault"))
    slim = stage(slim.groupBy("conv", "turn", "role", "key").agg(F.sum("copies").alias("m"), F.first("fault").alias("fault")), "tr-rows")
    place = F.struct(F.col("turn").isNotNull().alias("set"), "turn")
    again = slim.groupBy("conv", "role", "key").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    again = stage(again.select(F.col("conv").alias("_c"), F.col("role").alias("_r"), F.col("key").alias("_k"), "first"), "tr-again")
    met = slim.join(again, slim["conv"].eqNullSafe(again["_c"]) & (slim["role"] == again["_r"]) & (slim["key"] == again["_k"]), "left")
    return met.select("conv", "turn", "role", "key", "m", "fault", (F.col("first").isNotNull() & (F.col("first") != place)).alias("later"))


def _stretches(rows: DataFrame, order: list[Column], stretch: int) -> DataFrame:
    """``rows`` with ``seg`` and ``i``: stretches of at most so many rows of one conversation, numbered in the order of
    (conv, order); ``opens``: whether the stretch is known to begin its conversation."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, conv, i, opens, begun = TaskContext.get().partitionId() << 40, None, 0, False, False
        for batch in batches:
            segs, places, first = [], [], []
            for c in batch.column(0).to_pylist():
                if not begun or c != conv:
                    # what stands first in a partition may go on from the one before
                    seg, i, opens, conv, begun = seg + 1, 0, begun, c, True
                elif i == stretch:
                    seg, i, opens = seg + 1, 0, False
                i += 1
                segs.append(seg)
                places.append(i)
                first.append(opens)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segs, pa.int64()), pa.array(places, pa.int64()), pa.array(first, pa.bool_())], [*batch.schema.names, "seg", "i", "opens"])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col("conv").asc_nulls_first(), *order]
    dealt = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    own = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return dealt.mapInArrow(number, own + ", seg long, i long, opens boolean")


def _repaired(stretches: DataFrame, id_type: str, of_turns: bool, batch_rows: int) -> DataFrame:
    """The table of every stretch: (conv, seg, n, s, t, cost, audit, and of turns also illegal, head, tail)."""

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        duck = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})

        def solve(table: pa.Table) -> pa.Table:
            duck.register("given", table)
            duck.execute("create or replace temp table numbered as select *, dense_rank() over (order by seg)::bigint g from given")
            if of_turns:
                # a row that is there m times: the first may stay, the others go
                duck.execute("""
                    create or replace temp table turns as
                    select g, row_number() over (partition by g order by i, part)::bigint i, c, l, cut from (
                        select g, i, 0 part, c, (case when gone then m else 0 end)::bigint l, cut::bigint cut from numbered
                        union all select g, i, 1, c, m - 1, 0 from numbered where not gone and m > 1)""")
                duck.execute(f"create or replace temp table elements as {EDGES}")
                more = """
                    select g, any_value(conv) conv, any_value(seg) seg, count(*) n, max(i) last, sum(m - 1 + (i > 1 and (before || c) not in ('su', 'ua', 'au'))::int) illegal,
                           min_by(c, i) head, max_by(c, i) tail
                    from (select *, lag(c) over (partition by g order by i) before from numbered) group by g"""
            else:
                duck.execute("create or replace temp table elements as select g, dense_rank() over (partition by g order by i)::bigint i, s, t, cost, audit ext from numbered")
                more = "select g, any_value(conv) conv, any_value(seg) seg, count(*) n, 0 illegal, '' head, '' tail from numbered group by g"
            begins = "from numbered, (values (0), (1), (2), (3)) states(s) where s = 0 or not opens" if of_turns else "from elements where i = 1"
            duck.execute(f"create or replace temp table firsts as select distinct g, s {begins}")
            out = duck.sql(f"select conv, seg, n::bigint n, s::int s, t::int t, cost::bigint cost, audit, illegal::bigint illegal, head, tail from ({REPAIR}) join ({more}) using (g)")
            return out.to_arrow_table()

        def given() -> Iterator[pa.Table]:
            """Whole stretches, about ``batch_rows`` rows of them."""
            held, n = [], 0
            for batch in batches:
                at = 0
                segs = batch.column("seg").to_pylist()
                while n + len(segs) - at >= batch_rows:
                    # the stretch at the batch's end goes on to the next one
                    cut = next((k for k in range(max(at, at + batch_rows - n - 1), len(segs)) if k + 1 < len(segs) and segs[k] != segs[k + 1]), None)
                    if cut is None:
                        break
                    yield pa.Table.from_batches([*held, batch.slice(at, cut + 1 - at)])
                    held, n, at = [], 0, cut + 1
                if at < len(segs):
                    held.append(batch.slice(at))
                    n += len(segs) - at
            if held:
                yield pa.Table.from_batches(held)

        for table in given():
            yield from solve(table).cast(wanted(table.schema.field("conv").type)).to_batches(max_chunksize=2_000)

    def wanted(id_kind: pa.DataType) -> pa.Schema:
        long, string = pa.int64(), pa.string()
        return pa.schema(list(zip(["conv", "seg", "n", "s", "t", "cost", "audit", "illegal", "head", "tail"], [id_kind, long, long, pa.int32(), pa.int32(), long, string, long, string, string], strict=True)))

    dealt = stretches.repartition("conv", "seg").sortWithinPartitions("seg", "i")
    return dealt.mapInArrow(repair, _FOUND.format(id=id_type))


def repaired_tables(rows: DataFrame, stretch: int = STRETCH, batch_rows: int = BATCH) -> tuple[DataFrame, DataFrame]:
    """Of rows of :func:`judged`: (conv, cost, audit), and (conv, illegal)."""
    id_type = rows.schema["conv"].dataType.simpleString()
    gone = (F.col("fault") == "blank") | F.col("later")
    slim = rows.select("conv", "turn", "role", "key", F.substring("role", 1, 1).alias("c"), "m", gone.alias("gone"), (F.col("fault") == "truncated").cast("int").alias("cut"))
    numbered = stage(_stretches(slim, _in_order(), stretch).select("conv", "seg", "i", "opens", "c", "m", "gone", "cut"), "tr-turns")
    tables = stage_frames(_repaired(numbered, id_type, True, batch_rows), "tr-tables", 10_000)
    unstage(numbered)
    ends = tables.groupBy("conv", "seg").agg(F.first("illegal").alias("illegal"), F.first("head").alias("head"), F.first("tail").alias("tail"))
    pair = F.concat(F.lag("tail").over(Window.partitionBy("conv").orderBy("seg")), F.col("head"))
    ends = ends.withColumn("across", F.coalesce((~pair.isin("su", "ua", "au")).cast("long"), F.lit(0)))
    illegal = stage(ends.groupBy("conv").agg(F.sum(F.col("illegal") + F.col("across")).alias("illegal")), "tr-illegal")
    done = None
    while True:
        size = tables.groupBy("conv").agg(F.countDistinct("seg").alias("segs"), F.min("seg").alias("least"))
        size = size.withColumnRenamed("conv", "_c")
        sized = stage(tables.join(size, tables["conv"].eqNullSafe(size["_c"])).drop("_c"), "tr-sized")
        unstage(tables)
        whole = sized.where("segs = 1 and s = 0").select("conv", "t", "cost", "audit")
        done = whole if done is None else done.unionByName(whole)
        rest = sized.where("segs > 1").withColumnRenamed("seg", "of")
        if rest.isEmpty():
            break
        table = ("s", "t", "cost", "audit")
        # so many at least, for a range shuffle may part what it numbers at each bound between its partitions
        few = max(stretch, 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        joined = rest.where(F.col("segs") <= few).select("conv", (-F.col("least")).alias("seg"), F.col("of").alias("i"), *table)
        long = rest.where(F.col("segs") > few)
        # one row a stretch is numbered; its table follows
        heads = _stretches(long.select("conv", "of").distinct(), [F.col("of").asc()], stretch)
        heads = stage(heads.select(F.col("of").alias("_of"), "seg", "i"), "tr-heads")
        joined = joined.unionByName(long.join(heads, long["of"] == heads["_of"]).select("conv", "seg", "i", *table))
        tables = stage_frames(_repaired(joined, id_type, False, batch_rows), "tr-tables", 10_000)
    last = F.when(F.col("t") == 1, "II").when(F.col("t") == 2, "I").otherwise("")
    ended = done.select("conv", F.struct((F.col("cost") + 2 * F.length(last)).alias("cost"), F.concat("audit", last).alias("audit")).alias("best"))
    best = ended.groupBy("conv").agg(F.min("best").alias("best")).select("conv", "best.cost", "best.audit")
    return stage(best, "tr-best"), illegal


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, sha) of repaired conversations; rows: conv, audit (of the first row of a conversation), role, text, copies."""
    roles = {0: "user", 1: "user", 2: "assistant", 3: "user"}
    behind = {"s": 1, "u": 2, "a": 3}
    conv = audit = digest = None
    at = state = 0
    found: list[tuple] = []
    empty = True

    def add(role: str, text: str) -> None:
        nonlocal empty, state
        digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
        empty, state = False, behind[role[0]]

    def inserts() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            add(roles[state], "")
            at += 1

    for batch in batches:
        for c, edits, role, text, copies in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if edits is not None:
                if digest is not None:
                    inserts()
                    found.append((conv, digest.hexdigest()))
                conv, audit, digest, at, state, empty = c, edits, hashlib.sha256(), 0, 0, True
                continue
            for _ in range(copies):
                inserts()
                if audit[at] == "K":
                    add(role, text)
                elif audit[at] == "R":
                    add(roles[state], text)
                at += 1
        if len(found) > 5_000:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], batch.schema.field(0).type), pa.array([x for _, x in found])], ["conv", "sha"])
            found = []
    if digest is not None:
        inserts()
        found.append((conv, digest.hexdigest()))
    if found:
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], batch.schema.field(0).type), pa.array([x for _, x in found])], ["conv", "sha"])


def repair(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", stretch: int = STRETCH, batch_rows: int = BATCH) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation of ``turns``, after :func:`damaged`."""
    rows = damaged(turns, id_col, turn_col, role_col, text_col)
    faults = stage(judged(rows), "tr-judged")
    best, illegal = repaired_tables(faults, stretch, batch_rows)
    m, blank = F.col("m"), F.col("fault") == "blank"
    plain = ~blank & ~F.col("later")
    of_turn = faults.groupBy("conv", "turn").agg(
        F.sum(F.when(blank, m).otherwise(0)).alias("blank"),
        F.sum(F.when(blank, 0).when(F.col("later"), m).otherwise(m - 1)).alias("duplicate"),
        F.sum((plain & (F.col("fault") == "truncated")).cast("long")).alias("truncated"),
    )
    counts = of_turn.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated")],
    )
    ids = turns.select(F.col(f"`{id_col}`").alias("conv")).distinct()
    for k, part in enumerate((counts, illegal, best)):
        part = part.withColumnRenamed("conv", f"_c{k}")
        ids = ids.join(part, ids["conv"].eqNullSafe(part[f"_c{k}"]), "left").drop(f"_c{k}")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    heads = stage(ids.select("conv", *zero, F.coalesce("audit", F.lit("")).alias("audit")), "tr-heads")
    none = lambda kind: F.lit(None).cast(kind)
    lines = heads.select("conv", F.lit(0).alias("o"), none("long").alias("turn"), none("binary").alias("key"), "audit", none("string").alias("role"), none("string").alias("text"), none("int").alias("copies"))
    lines = lines.unionByName(rows.select("conv", F.lit(1).alias("o"), "turn", _key(F.col("text")).alias("key"), none("string").alias("audit"), "role", "text", "copies"))
    dealt = lines.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "o", *_in_order()).select("conv", "audit", "role", "text", "copies")
    id_type = heads.schema["conv"].dataType.simpleString()
    digests = stage_frames(dealt.mapInArrow(_digests, f"conv {id_type}, sha string"), "tr-digests", 2_000).withColumnRenamed("conv", "_c")
    out = heads.join(digests, heads["conv"].eqNullSafe(digests["_c"]))
    return out.select(F.col("conv").alias(id_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("sha").alias("repaired_sha256"))
