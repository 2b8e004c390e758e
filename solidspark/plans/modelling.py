"""More modelling operators over the driver's tables, each with its SQL: merging in cascade, faceting, transform journals,
booleans with their pieces, decks with regions of their own.

See :mod:`solidspark.plans.carrier` for what the tables stand for."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from solidspark.commands import ExportOptions
from solidspark.model import Model
from solidspark.operators import entities, faceting, journal, merge, mesh, octree
from solidspark.plans.carrier import BASE, QUERIES, Carrier, _bodies, query
from solidspark.skew import shuffled
from solidspark.sources import imports, regions, universes
from solidspark.sources.deck import DeckOptions

MERGE_TOL = 0.02
#: Vertices at three places with a little room around them: one a line item. Curves lead from line to line of an order and back,
#: surfaces are orders, volumes customers, which have odd orders from inside. Ids of curves and surfaces follow those of vertices.
_E, _S, _W = 10**12, 2 * 10**12, 3 * 10**12


def _lines(m: Carrier) -> DataFrame:
    """(o, l, part): the different lines of orders."""
    return m.t("lineitem").groupBy(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("l")).agg(F.min("l_partkey").alias("part"))


def _corners(m: Carrier) -> DataFrame:
    place = F.col("part") % 3
    return _lines(m).select((F.col("o") * 8 + F.col("l")).alias("ent_id"), (place + F.col("l") * 0.001).alias("x"), (place * 0.5).alias("y"), F.lit(0.0).alias("z"))


def _links(m: Carrier) -> DataFrame:
    of_order = Window.partitionBy("o").orderBy("l")
    whole = of_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    at = _lines(m).withColumn("v", F.col("o") * 8 + F.col("l"))
    at = at.withColumn("nxt", F.coalesce(F.lead("v").over(of_order), F.first("v").over(whole)))
    ends = F.explode(F.array(F.struct(F.col("v").alias("c"), F.lit(-1).alias("s")), F.struct(F.col("nxt").alias("c"), F.lit(1).alias("s")))).alias("e")
    edges = at.select((F.col("v") + _E).alias("parent_id"), ends).select("parent_id", F.col("e.c").alias("child_id"), F.lit(1).alias("parent_dim"), F.col("e.s").alias("sense"))
    faces = at.select((F.col("o") + _S).alias("parent_id"), (F.col("v") + _E).alias("child_id"), F.lit(2).alias("parent_dim"), F.lit(1).alias("sense"))
    inside = F.when(F.col("o_orderkey") % 2 == 1, -1).otherwise(1)
    volumes = m.t("orders").select((F.col("o_custkey") + _W).alias("parent_id"), (F.col("o_orderkey") + _S).alias("child_id"), F.lit(3).alias("parent_dim"), inside.alias("sense"))
    return edges.unionByName(faces).unionByName(volumes)


#: The same level by level, on lists of (child, sense) as texts: a list and the list with all senses turned are one surface.
_MERGED = f"""
    lines as (select l_orderkey o, l_linenumber l, min(l_partkey) part from lineitem group by 1, 2),
    v as (select o * 8 + l id, o, l, min(o * 8 + l) over (partition by part % 3) keep from lines),
    e0 as (select id + {_E} id, o, keep a, coalesce(lead(keep) over w, first_value(keep) over w) b from v window w as (partition by o order by l rows between unbounded preceding and unbounded following)),
    e1 as (select *, first_value(id) over w keep, first_value(a) over w ka from e0 window w as (partition by least(a, b), greatest(a, b) order by id)),
    e as (select id, o, keep, case when a = ka then 1 else -1 end sense from e1),
    f0 as (select o + {_S} id, o, string_agg(keep || ':' || sense, ',' order by keep, sense) fwd, string_agg(keep || ':' || -sense, ',' order by keep, -sense) rev from (select distinct o, keep, sense from e) group by o),
    f1 as (select *, first_value(id) over w keep, first_value(fwd) over w kf from f0 window w as (partition by least(fwd, rev), greatest(fwd, rev) order by id)),
    f as (select id, o, keep, case when fwd = kf then 1 else -1 end sense from f1),
    w0 as (select o_custkey + {_W} id, string_agg(keep || ':' || s, ',' order by keep, s) made from (select distinct o_custkey, keep, sense * case when o_orderkey % 2 = 1 then -1 else 1 end s from orders join f on f.o = o_orderkey) group by 1),
    w as (select id, min(id) over (partition by made) keep from w0),
    merged as (select id ent_id, 0 dim, keep, 1 sense from v union all select id, 1, keep, sense from e union all select id, 2, keep, sense from f union all select id, 3, keep, 1 from w)"""


@query(f"with {_MERGED} select ent_id, dim, keep, sense from merged")
def merge_cascade(m):
    return merge.merge_cascade(_corners(m), _links(m), MERGE_TOL)


@query(f"""with {_MERGED}, links as (select id + {_E} p, id c, 1 d, -1 s from v union all select v.id + {_E}, coalesce(lead(v.id) over w, first_value(v.id) over w), 1, 1 from v window w as (partition by o order by l rows between unbounded preceding and unbounded following)
    union all select o + {_S}, id, 2, 1 from e union all select o_custkey + {_W}, o_orderkey + {_S}, 3, case when o_orderkey % 2 = 1 then -1 else 1 end from orders)
    select distinct coalesce(a.keep, p) parent_id, coalesce(b.keep, c) child_id, d parent_dim, s * coalesce(a.sense, 1) * coalesce(b.sense, 1) sense
    from links left join merged a on a.ent_id = p left join merged b on b.ent_id = c""")
def merged_links(m):
    """Topology after the merge."""
    return merge.merged_links(_links(m), merge.merge_cascade(_corners(m), _links(m), MERGE_TOL))


def _model(m: Carrier) -> Model:
    """The carrier's entities with links, bodies, uses of surfaces by volumes and of curves by surfaces, and a mesh vertex at each vertex."""
    n, c, o = m.t("nation"), m.t("customer"), m.t("orders")
    entity = m.entity().select(F.lit("m").alias("model_id"), "ent_id", "dim", F.lit("").alias("category"), (F.col("ent_id") % 1000).cast("int").alias("global_id"))
    surface, curve = F.col("n_nationkey").cast("long") + BASE["surface"], F.col("c_custkey") + BASE["curve"]
    use = lambda k: F.element_at(F.array(F.lit("A"), F.lit("R"), F.lit("U")), (k % 3 + 1).cast("int"))
    uses = n.select(surface.alias("child_id"), F.col("n_regionkey").cast("long").alias("parent_id"), F.when(F.col("n_nationkey") % 2 == 0, "A").otherwise("R").alias("use_sense"))
    uses = uses.unionByName(c.select(curve.alias("child_id"), (F.col("c_nationkey").cast("long") + BASE["surface"]).alias("parent_id"), use(F.col("c_custkey")).alias("use_sense")))
    vertex = F.col("o_orderkey") + BASE["vertex"]
    member = c.select((F.col("c_custkey") % 3).alias("group_id"), curve.alias("member_id"), F.lit("entity").alias("member_kind"))
    tables = {
        "entity": entity, "topology": QUERIES["topology_links"](m), "body_volume": _bodies(m), "sense_use": uses.withColumn("geom_sense", F.lit("A")), "group_member": member,
        "mesh_vertex": o.select(F.col("o_orderkey").alias("vh"), vertex.alias("owner_id"), F.col("o_totalprice").alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("z")),
        "tag_value": o.select(vertex.alias("ent_id"), F.lit(1).alias("handle"), F.lit(None).cast("binary").alias("value"), F.col("o_orderkey").alias("seq")),
    }
    return Model(m.spark, "m", tables)


@query(f"""with u as (select n_nationkey::bigint + {BASE["surface"]} child_id, n_regionkey::bigint parent_id, case when n_nationkey % 2 = 0 then 'A' else 'R' end u from nation
    union all select c_custkey + {BASE["curve"]}, c_nationkey::bigint + {BASE["surface"]}, ['A', 'R', 'U'][c_custkey % 3 + 1] from customer)
    select child_id, parent_id, 1 sense from u where u in ('A', 'U') union all select child_id, parent_id, -1 from u where u in ('R', 'U')""")
def export_senses(m):
    """Senses as an export writes them: of surfaces and of curves, which may have any number of surfaces on a side."""
    return _model(m).senses()


@query(f"""with b as (select r_regionkey::bigint v from region where r_regionkey < 4 and r_regionkey // 2 = 0),
    gone as (select v id from b union select c_custkey + {BASE["curve"]} from customer where c_custkey % 4 = 0)
    select 'topology' as name, count(*) n from (select n_regionkey::bigint p, n_nationkey::bigint + {BASE["surface"]} c from nation union all select c_nationkey::bigint + {BASE["surface"]}, c_custkey + {BASE["curve"]} from customer
        union all select o_custkey + {BASE["curve"]}, o_orderkey + {BASE["vertex"]} from orders) where p not in (select id from gone) and c not in (select id from gone)
    union all select 'sense_use', (select count(*) from nation where n_regionkey not in (select id from gone)) + (select count(*) from customer where c_custkey % 4 > 0)
    union all select 'body_volume', 2 from region where r_regionkey = 0 union all select 'group_member', count(*) from customer where c_custkey % 4 > 0
    union all select 'mesh_vertex', count(*) from orders union all select 'tag_value', count(*) from orders""")
def model_delete(m):
    """Rows of each table once one volume (with its body and that body's other volume) and every fourth curve are gone."""
    model = _model(m)
    model.delete(m.t("customer").where("c_custkey % 4 = 0").select((F.col("c_custkey") + BASE["curve"]).alias("ent_id")).union(m.spark.range(1).toDF("ent_id")))
    out = None
    for name in ("topology", "sense_use", "body_volume", "group_member", "mesh_vertex", "tag_value"):
        one = model[name].agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query(f"""with links as (select n_regionkey::bigint p, n_nationkey::bigint + {BASE["surface"]} c from nation union all select c_nationkey::bigint + {BASE["surface"]}, c_custkey + {BASE["curve"]} from customer
        union all select o_custkey + {BASE["curve"]}, o_orderkey + {BASE["vertex"]} from orders),
    v as (select r_regionkey::bigint id from region where r_regionkey in (2, 3)), s as (select n_nationkey::bigint + {BASE["surface"]} id from nation where n_regionkey in (2, 3)),
    c as (select c_custkey + {BASE["curve"]} id from customer where c_nationkey + {BASE["surface"]} in (select id from s)), p as (select o_orderkey + {BASE["vertex"]} id from orders where o_custkey + {BASE["curve"]} in (select id from c)),
    ids as (select id, (select max(o_orderkey) from orders) + {BASE["vertex"]} + row_number() over (order by id) k from (select * from v union all select * from s union all select * from c union all select * from p))
    select a.k parent_id, b.k child_id, (a.id % 1000)::int parent_global from links join ids a on a.id = p join ids b on b.id = c""")
def model_copy(m):
    """Links among the copies of one volume, its body's other volume, and all that they are made of; new ids follow the old ones' order."""
    model = _model(m)
    last = entities.next_id(model["entity"])
    model.copy(m.spark.range(3, 4).toDF("ent_id"))
    links = model["topology"].where(F.col("parent_id") >= last).select("parent_id", "child_id")
    return links.join(model["entity"].select(F.col("ent_id").alias("parent_id"), F.col("global_id").alias("parent_global")), "parent_id")


#: Of every part a primitive: six kinds, the last a torus without a hole.
COARSE = ExportOptions(faceting_tolerance=0.5, normal_tolerance=30, length_tolerance=12.0)


def _solids(m: Carrier) -> DataFrame:
    k, s = F.col("p_partkey") % 6, F.col("p_size").cast("double")
    kind = F.element_at(F.array(*map(F.lit, ("brick", "cylinder", "cone", "sphere", "torus", "torus"))), (k + 1).cast("int"))
    b = F.when(k == 0, s / 2).when(k.isin(1, 2), s).when(k == 4, s / 2).when(k == 5, 2 * s).otherwise(0.0)
    c = F.when(k == 0, s / 4).when(k == 1, s / 2).otherwise(0.0)
    d = F.when((k == 2) & (F.col("p_size") % 2 == 0), s / 2).otherwise(0.0)
    return m.t("part").select(F.col("p_partkey").alias("ent_id"), kind.alias("kind"), s.alias("a"), b.alias("b"), c.alias("c"), d.alias("d"))


#: Counts by the sagitta, the turn and the length of chords; volumes of stacked frustums over regular polygons.
_SIDES = "ceil(greatest(3.0::double, pi() / acos(greatest(-1.0::double, 1 - 0.5::double / {r})), 360.0::double / 30, pi() / asin(least(1.0::double, 12.0::double / (2 * {r})))) - 1e-9::double)::int"
_SHELLS = f"""
    s as (select p_partkey id, (p_partkey % 6)::int k, p_size::double s, p_size from part),
    c as (select *, case when k = 0 then 4 when k in (1, 2) then {_SIDES.format(r="s")} when k = 3 then {_SIDES.format(r="s")} when k = 4 then {_SIDES.format(r="(s + s / 2)")} else {_SIDES.format(r="(s + 2 * s)")} end n,
          case when k = 3 then {_SIDES.format(r="s")} when k = 4 then {_SIDES.format(r="(s / 2)")} when k = 5 then {_SIDES.format(r="(2 * s)")} end small, pi() - acos(0.5::double) half from s),
    m as (select *, case k when 1 then 2 when 2 then case when p_size % 2 = 0 then 2 else 1 end when 3 then greatest(2, ceil(small / 2.0::double)::int) - 1 when 4 then small when 5 then greatest(2, ceil(small * half / pi() - 1e-9::double)::int) - 1 end rings from c),
    rings as (select id, n, k, rings, unnest(case when k in (3, 5) then range(0, rings + 2) when k = 4 then range(0, rings + 1) when k = 0 then []::bigint[] else range(0, rings + 2) end) i, s, p_size, half from m),
    prof as (select id, n, k, i, s, case k when 1 then case when i in (1, 2) then s else 0 end when 2 then case when i = 1 then s when i = 2 and rings = 2 then s / 2 else 0 end when 3 then s * cos(pi() * (i / (rings + 1.0::double) - 0.5::double))
               when 4 then s + s / 2 * cos(2 * pi() * i / rings) else s + 2 * s * cos(half * (2 * i / (rings + 1.0::double) - 1)) end r,
             case k when 1 then case when i < 2 then -s / 2 else s / 2 end when 2 then case when i < 2 then -s / 2 else s / 2 end when 3 then s * sin(pi() * (i / (rings + 1.0::double) - 0.5::double)) when 4 then s / 2 * sin(2 * pi() * i / rings) else 2 * s * sin(half * (2 * i / (rings + 1.0::double) - 1)) end z from rings),
    bands as (select *, lead(r) over (partition by id order by i) r2, lead(z) over (partition by id order by i) z2 from prof),
    vols as (select id, sum((z2 - z) / 3 * (r * r + r * r2 + r2 * r2)) * any_value(n) / 2 * sin(2 * pi() / any_value(n)) * case any_value(k) when 1 then 0.5::double else 1 end volume from bands where r2 is not null group by id),
    shells as (select id, case when k = 0 then 8 when k = 4 then n * rings else n * rings + 2 end n_vertices, case when k = 0 then 12 else 2 * n * rings end n_triangles, coalesce(volume, s * s / 2 * s / 4) volume, k from m left join vols using (id))"""


@query(f"with {_SHELLS} select id ent_id, n_vertices::bigint n_vertices, n_triangles::bigint n_triangles, round(volume, 3) + 0 volume, (case when k = 4 then 0 else 2 end)::bigint euler, 0::bigint open from shells")
def primitive_facets(m):
    """Of each primitive's mesh: counts, the volume that it encloses, Euler's number, and sides that are not closed."""
    vertices, elements = faceting.solid_mesh(_solids(m), COARSE)
    size = faceting.solid_sizes(_solids(m), COARSE).select(F.col("owner_id").alias("ent_id"), F.col("n").alias("n_triangles"), (F.round("volume", 3) + 0).alias("volume"))
    n_v = vertices.groupBy(F.col("owner_id").alias("ent_id")).agg(F.count("*").alias("n_vertices"))
    sides = mesh.closedness(elements).select(F.col("volume_id").alias("ent_id"), "n_sides", (F.col("missing") + F.col("flipped") + F.col("crowded")).alias("open"))
    out = n_v.join(shuffled(size), "ent_id").join(shuffled(sides), "ent_id")
    return out.select("ent_id", "n_vertices", "n_triangles", "volume", (F.col("n_vertices") - F.col("n_sides") + F.col("n_triangles")).alias("euler"), "open")


@query(f"""with {_SHELLS} select id volume_id, (n_triangles * 3 // 2)::bigint n_sides, (case when id % 4 = 2 then 3 else 0 end)::bigint missing, (case when id % 4 = 1 then 3 else 0 end)::bigint flipped, 0::bigint crowded, (case when id % 4 = 2 then 1 else 0 end)::bigint loops from shells""")
def volume_closedness(m):
    """A turned triangle and a missing one are told apart, whichever way a surface bounds its volume."""
    _, elements = faceting.solid_mesh(_solids(m), COARSE, keep=("ord",))
    first = F.col("ord") == 0
    damaged = elements.where((F.col("owner_id") % 4 != 2) | ~first)
    damaged = damaged.withColumn("conn", F.when((F.col("owner_id") % 4 == 1) & first, F.reverse("conn")).otherwise(F.col("conn")))
    senses = _solids(m).select(F.col("ent_id").alias("child_id"), F.col("ent_id").alias("parent_id"), F.when(F.col("ent_id") % 7 == 0, -1).otherwise(1).alias("sense"))
    return mesh.closedness(damaged, senses)


def _journal(m: Carrier) -> DataFrame:
    """Every event an operation on its user's body: moves, turns, mirrored scalings and reflections, and some that fail; every
    fifth user is a surface, which cannot be moved or turned."""
    k, axis = F.col("event_id") % 7, F.col("event_id") % 3
    op = F.element_at(F.array(*map(F.lit, ("move", "rotate", "scale", "reflect", "rotate", "shear", "move"))), (k + 1).cast("int"))
    of = lambda *v: F.element_at(F.array(*[x if hasattr(x, "cast") else F.lit(float(x)) for x in v]), (k + 1).cast("int"))
    turn = (30 * (F.col("event_id") % 12)).cast("double")
    args = [of(F.round("value").cast("double"), turn, 1, 0, 30, 0, 0.25), of(1, (axis == 0).cast("double"), 0, 0, 0, 0, 0), of(-1, (axis == 1).cast("double"), 0.25, 1, 0, 0, 0.5), of(0, (axis == 2).cast("double"), -1, 1, 0, 0, 0), of(0, 0, 1, 2, 0, 0, 0), of(0, 0, 1, 2, 0, 0, 0)]
    return m.t("events").select(F.col("user_id").alias("ent_id"), F.when(F.col("user_id") % 5 == 0, "surface").otherwise("body").alias("kind"), F.col("event_id").alias("seq"), op.alias("op"), *[c.alias(f"a{i}") for i, c in enumerate(args)])


_STATUS = """case when event_id % 7 = 5 then 21 when user_id % 5 = 0 and event_id % 7 in (0, 1, 4, 6) then 9 when event_id % 7 = 4 then 19 else 0 end"""
#: Each event's map as a row of twelve, then one event after the other, user by user.
_COMPOSED = f"""
    ok as (select user_id u, event_id e, event_id % 7 k, event_id % 3 ax, round(value)::double v, radians((30 * (event_id % 12))::double) t, row_number() over (partition by user_id order by event_id) i from events where {_STATUS} = 0),
    maps as (select u, e, i, case k when 0 then [1, 0, 0, v, 0, 1, 0, 1, 0, 0, 1, -1]::double[] when 6 then [1, 0, 0, 0.25, 0, 1, 0, 0, 0, 0, 1, 0.5]::double[] when 2 then [-1, 0, 0, 2, 0, 1, 0, 0, 0, 0, 1, 0]::double[]
        when 3 then [7 / 9.0::double, -4 / 9.0::double, -4 / 9.0::double, 4 / 9.0::double, -4 / 9.0::double, 1 / 9.0::double, -8 / 9.0::double, 8 / 9.0::double, -4 / 9.0::double, -8 / 9.0::double, 1 / 9.0::double, 8 / 9.0::double]
        else case ax when 0 then [1, 0, 0, 0, 0, cos(t), -sin(t), 0, 0, sin(t), cos(t), 0] when 1 then [cos(t), 0, sin(t), 0, 0, 1, 0, 0, -sin(t), 0, cos(t), 0] else [cos(t), -sin(t), 0, 0, sin(t), cos(t), 0, 0, 0, 0, 1, 0] end end m from ok),
    run(u, i, f) as (select u, 0::bigint, [1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0]::double[] from (select distinct u from maps)
        union all select r.u, m.i, list_transform(range(12), lambda x: m.m[(x // 4 * 4 + 1)::int] * f[(x % 4 + 1)::int] + m.m[(x // 4 * 4 + 2)::int] * f[(x % 4 + 5)::int] + m.m[(x // 4 * 4 + 3)::int] * f[(x % 4 + 9)::int] + case when x % 4 = 3 then m.m[(x // 4 * 4 + 4)::int] else 0 end)
        from run r join maps m on m.u = r.u and m.i = r.i + 1),
    done as (select u, max(i) n, arg_max(f, i) f from run group by 1),
    turns as (select u, (sum(case when k in (2, 3) then 1 else 0 end) % 2) = 1 turned from ok group by 1)"""


@query(f"select user_id ent_id, event_id seq, ({_STATUS})::int status from events")
def journal_status(m):
    return journal.judged(_journal(m)).select("ent_id", "seq", F.col("status").cast("int").alias("status"))


@query(f"with recursive {_COMPOSED} select u ent_id, n, turned, array_to_string(list_transform(f, lambda x: (round(x * 1000)::bigint)::varchar), ',') thousandths from done join turns using (u)")
def transform_journal(m):
    """Each user's operations in order as one map, and whether it turns triangles inside out."""
    done = journal.composed(journal.judged(_journal(m)).where("status = 0"))
    shown = F.transform("map", lambda x: F.round(x * 1000).cast("long").cast("string"))
    return done.select("ent_id", "n", journal.turned(F.col("map")).alias("turned"), F.array_join(shown, ",").alias("thousandths"))


@query(f"""with recursive {_COMPOSED}, points as (select vec_id, vec_id % 100 u, embedding[1]::double x, embedding[2]::double y, embedding[3]::double z from embeddings)
    select vec_id, round(coalesce(f[1] * x + f[2] * y + f[3] * z + f[4], x), 3) + 0 x, round(coalesce(f[5] * x + f[6] * y + f[7] * z + f[8], y), 3) + 0 y, round(coalesce(f[9] * x + f[10] * y + f[11] * z + f[12], z), 3) + 0 z,
           case when coalesce(turned, false) then '3,2,1' else '1,2,3' end conn from points left join done using (u) left join turns using (u)""")
def journal_meshes(m):
    """Vertices and windings of the users' meshes after their journals."""
    done = journal.composed(journal.judged(_journal(m)).where("status = 0"))
    vertices = m.points().select("vec_id", (F.col("vec_id") % 100).alias("owner_id"), "x", "y", "z")
    elements = vertices.select("vec_id", "owner_id", F.array(F.lit(1), F.lit(2), F.lit(3)).alias("conn"))
    moved = journal.moved_vertices(vertices, done).select("vec_id", *[(F.round(c, 3) + 0).alias(c) for c in "xyz"])
    return moved.join(journal.moved_elements(elements, done).select("vec_id", F.array_join(F.col("conn").cast("array<string>"), ",").alias("conn")), "vec_id")


#: Every part a boolean of two primitives, the second at a place that its size gives; a third one is cut off every other part.
DEPTH = 3
_SHAPES = (("brick", 1.53, 1.11, 0.93, 0.0), ("cylinder", 1.31, 0.73, 0.51, 0.0), ("cone", 1.23, 0.83, 0.0, 0.31), ("sphere", 0.77, 0.0, 0.0, 0.0), ("torus", 0.71, 0.29, 0.0, 0.0))
_OPS = ("unite", "subtract", "intersect")


def _terms(m: Carrier) -> DataFrame:
    p, s = F.col("p_partkey"), F.col("p_size")
    shape = lambda k: F.element_at(F.array(*[F.struct(F.lit(n).alias("kind"), *[F.lit(v).alias(c) for c, v in zip("abcd", vs, strict=True)]) for n, *vs in _SHAPES]), (k % 5 + 1).cast("int"))
    place = lambda x, y, z: [v.cast("double").alias(k) for k, v in zip(("dx", "dy", "dz"), (x, y, z), strict=True)]
    nil = F.lit(0.0)
    row = lambda k, op, t, where: F.struct(F.lit(k).alias("ord"), op.alias("op"), t.alias("t"), *place(*where))
    first = row(0, F.lit("unite"), shape(p), (nil, nil, nil))
    second = row(1, F.element_at(F.array(*map(F.lit, _OPS)), (F.floor(p / 25) % 3 + 1).cast("int")), shape(F.floor(p / 5)), ((s % 7 - 3) * 0.53, (F.floor(s / 7) % 3 - 1) * 0.41, (p % 4) * 0.13))
    third = row(2, F.lit("subtract"), shape(F.lit(0)), ((s % 5 - 2) * 0.37, nil, F.lit(0.71)))
    each = F.when(p % 2 == 0, F.array(first, second, third)).otherwise(F.array(first, second))
    return m.t("part").select(p.alias("solid_id"), F.explode(each).alias("e")).select("solid_id", "e.ord", "e.op", "e.t.*", "e.dx", "e.dy", "e.dz")


def _inside_sql(x: str, y: str, z: str) -> str:
    """Whether a point is in the primitive of this row."""
    return f"""case kind when 'brick' then abs({x}) <= a / 2 and abs({y}) <= b / 2 and abs({z}) <= c / 2 when 'sphere' then {x} * {x} + {y} * {y} + {z} * {z} <= a * a
        when 'torus' then (sqrt({x} * {x} + {y} * {y}) - a) ** 2 + {z} * {z} <= b * b when 'cylinder' then ({x} / b) ** 2 + ({y} / c) ** 2 <= 1 and abs({z}) <= a / 2
        else ({x} / b) ** 2 + ({y} / b) ** 2 <= (1 + (d / b - 1) * ({z} + a / 2) / a) ** 2 and abs({z}) <= a / 2 end"""


_N = 2**DEPTH


@query(f"""with recursive shapes(k, kind, a, b, c, d) as (values {", ".join(f"({k}, '{s[0]}', {', '.join(f'{v}::double' for v in s[1:])})" for k, s in enumerate(_SHAPES))}),
    places as (select p_partkey s, 0 ord, 'unite' op, p_partkey % 5 k, 0.0::double dx, 0.0::double dy, 0.0::double dz from part
        union all select p_partkey, 1, ['unite', 'subtract', 'intersect'][p_partkey // 25 % 3 + 1], p_partkey // 5 % 5, (p_size % 7 - 3) * 0.53::double, (p_size // 7 % 3 - 1) * 0.41::double, (p_partkey % 4) * 0.13::double from part
        union all select p_partkey, 2, 'subtract', 0, (p_size % 5 - 2) * 0.37::double, 0, 0.71::double from part where p_partkey % 2 = 0),
    terms as (select * from places join shapes using (k)),
    halves as (select *, case kind when 'brick' then a / 2 when 'sphere' then a when 'torus' then a + b else b end hx, case kind when 'brick' then b / 2 when 'sphere' then a when 'torus' then a + b when 'cylinder' then c else b end hy,
               case kind when 'brick' then c / 2 when 'sphere' then a when 'torus' then b else a / 2 end hz from terms),
    boxes as (select s, min(dx - hx) lx, min(dy - hy) ly, min(dz - hz) lz, max(dx + hx) - min(dx - hx) wx, max(dy + hy) - min(dy - hy) wy, max(dz + hz) - min(dz - hz) wz from halves where op = 'unite' group by s),
    grid as (select *, lx + wx * (i + 0.5::double) / {_N} x, ly + wy * (j + 0.5::double) / {_N} y, lz + wz * (k + 0.5::double) / {_N} z from boxes, range({_N}) i(i), range({_N}) j(j), range({_N}) k(k)),
    tested as (select g.*, t.ord, t.op, {_inside_sql("(x - dx)", "(y - dy)", "(z - dz)")} held from grid g join terms t using (s)),
    kept as materialized (select s, i, j, k, any_value(lx) lx, any_value(ly) ly, any_value(lz) lz, any_value(wx) wx, any_value(wy) wy, any_value(wz) wz from tested group by s, i, j, k
             having case max(case when ord = 1 then op end) when 'unite' then bool_or(held and ord < 2) when 'subtract' then bool_or(held and ord = 0) and not bool_or(held and ord = 1) else bool_or(held and ord = 0) and bool_or(held and ord = 1) end
                    and not bool_or(held and ord = 2)),
    cells as (select s, i * {_N * _N} + j * {_N} + k id, i, j, k from kept),
    steps(di, dj, dk) as (values (0, 0, 0), (1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)),
    sides as materialized (select a.s, a.id, b.id other from (select *, i + di bi, j + dj bj, k + dk bk from cells, steps) a join cells b on a.s = b.s and bi = b.i and bj = b.j and bk = b.k),
    spread(s, id, label, n) as (select s, id, id, 0 from cells
        union all select d.s, d.id, min(q.label), q.n + 1 from spread q join sides d on q.s = d.s and q.id = d.other where q.n < 48 group by d.s, d.id, q.n),
    counted as (select s, count(distinct label) n from spread where n = 48 group by s),
    held as (select s, count(*) n_cells, min(lx + wx * i / {_N}) x0, min(ly + wy * j / {_N}) y0, min(lz + wz * k / {_N}) z0, max(lx + wx * (i + 1) / {_N}) x1, max(ly + wy * (j + 1) / {_N}) y1, max(lz + wz * (k + 1) / {_N}) z1 from kept group by s)
    select b.s solid_id, (case when n > 0 then 0 else 22 end)::int status, coalesce(n, 0) n_pieces, coalesce(n_cells, 0) n_cells, round(x0, 6) min_x, round(y0, 6) min_y, round(z0, 6) min_z, round(x1, 6) max_x, round(y1, 6) max_y, round(z1, 6) max_z
    from boxes b left join counted using (s) left join held using (s)""")
def boolean_bodies(m):
    """What booleans leave: an empty result is a failure, else its pieces, cells and box on a grid."""
    found = octree.pieces(_terms(m), DEPTH)
    return found.drop("volume").withColumns({c: F.round(c, 6) for c in found.columns[5:]}).withColumn("status", F.col("status").cast("int"))


def _own_decks(m: Carrier) -> DataFrame:
    """A deck for every part: a ball, a box, a turned and moved cylinder and an elliptic one, with unions and complements of parentheses and of cells."""
    r, top = ((F.col("p_size") % 5 + 1) * 0.5).cast("double").cast("string"), ((F.col("p_partkey") % 3 + 1) * 0.25).cast("double").cast("string")
    text = F.concat(
        F.lit("part\n1 0 -8 -11\n2 1 -1.5 (-9 : -10 11) 8\n3 2 -2.0 -7 #1 #2\n4 0 7 #(-9 : -10 11) imp:n=1\n5 0 #1 #2 #3 #4\n\n7 so "), r, F.lit("\n8 rpp -1 1 -0.5 0.5 -0.25 "), top,
        F.lit("\n9 5 rcc 0 0 0 0 0 1 0.4\n10 gq 1 2 0 0 0 0\n     0 0 0 -1\n11 pz 0\n\ntr5 0.5 0.25 -0.5 0 1 0 0 0 1 1 0 0\nm1 1001 1.0\n"),
    )
    return m.t("part").select(F.col("p_partkey").cast("string").alias("deck"), text.alias("value"))


@query("""with p as (select l_partkey::varchar deck, (l_quantity - 25) / 10 x, l_discount * 20 - 1 y, l_tax * 20 - 0.8::double z, (p_size % 5 + 1) * 0.5::double r, (p_partkey % 3 + 1) * 0.25::double top from lineitem join part on l_partkey = p_partkey),
    s as (select *, x * x + y * y + z * z - r * r ball, greatest(-1 - x, x - 1, -0.5::double - y, y - 0.5::double, -0.25::double - z, z - top) box,
          greatest(-(x - 0.5::double), x - 0.5::double - 1, (y - 0.25::double) * (y - 0.25::double) + (z + 0.5::double) * (z + 0.5::double) - 0.4::double * 0.4::double) tube, x * x + 2 * y * y - 1 gq from p),
    c as (select *, box < 0 and z < 0 c1, (tube < 0 or (gq < 0 and z > 0)) and box > 0 c2, tube < 0 or (gq < 0 and z > 0) u from s),
    d as (select *, ball < 0 and not c1 and not c2 c3, ball > 0 and not u c4 from c)
    select deck, case when c1 then 1 when c2 then 2 when c3 then 3 when c4 then 4 else 5 end cell, count(*) n from d group by 1, 2""")
def deck_regions(m):
    """Line items as points, each classified by the deck of its part."""
    at = m.t("lineitem").select(F.col("l_partkey").cast("string").alias("deck"), ((F.col("l_quantity") - 25) / 10).alias("x"), (F.col("l_discount") * 20 - 1).alias("y"), (F.col("l_tax") * 20 - 0.8).alias("z"))
    known = at.join(shuffled(m.t("part").select(F.col("p_partkey").cast("string").alias("deck"))), "deck", "left_semi")
    return regions.classify(known, _own_decks(m)).groupBy("deck", "cell").agg(F.count("*").alias("n"))


@query("""with d as (select p_partkey::varchar deck, (p_size % 5 + 1) * 0.5::double r from part),
    h as (select deck, least(-1, -r) x0, least(-0.5::double, -r) y0, least(-0.25::double, -r) z0, greatest(1, r) x1, greatest(0.5::double, r) y1, greatest(0, r) z1 from d), s as (select *, greatest(x1 - x0, y1 - y0, z1 - z0) * 0.1::double m from h)
    select deck, round(x0 - m, 9) inner_x, round(z0 - m, 9) inner_z, round(y1 + m, 9) inner_top, round(x0 - 2 * m, 9) outer_x, round(z1 + 2 * m, 9) outer_top from s""")
def deck_graveyards(m):
    """The shell around what has bounds in each part's deck: its ball, and its box below a plane."""
    found = imports.graveyards(_own_decks(m), DeckOptions())
    at = lambda c, k: F.round(F.get(c, F.lit(k)), 9)
    return found.select("deck", at("inner", 0).alias("inner_x"), at("inner", 2).alias("inner_z"), at("inner", 4).alias("inner_top"), at("outer", 0).alias("outer_x"), at("outer", 5).alias("outer_top"))


@query("""select options, p_partkey::varchar deck, name, cell_id from part, (values ('', 'mat:1/rho:-1.5', 2), ('', 'mat:2/rho:-2.0', 3), ('', 'imp:n=1', 4), ('skip_mats', 'imp:n=1', 4), ('skip_imps', 'mat:1/rho:-1.5', 2), ('skip_imps', 'mat:2/rho:-2.0', 3)) v(options, name, cell_id)""")
def deck_groups(m):
    """Groups of cells by material and importance, and what each option leaves out."""
    out = None
    for word in ("", "skip_mats", "skip_imps"):
        one = imports.groups(_own_decks(m), DeckOptions.parse(word.split())[0]).withColumn("options", F.lit(word))
        out = one if out is None else out.unionByName(one)
    return out


def _nested_decks(m: Carrier) -> DataFrame:
    """A deck for every part, three levels deep: a box of a lattice of three by three elements, in them pins with a moved
    universe around them, balls, and one element left as it is; outside of it nothing. Every tenth part fills a universe with its own ancestor."""
    r = ((F.col("p_size") % 4 + 1) * 0.1).cast("string")
    ring = F.when(F.col("p_partkey") % 10 == 0, F.lit("fill=1")).otherwise(F.lit(""))
    text = F.concat(
        F.lit("nested\n1 0 -1 fill=1\n2 0 1\n3 0 -2 lat=1 u=1 fill=-1:1 -1:1 0:0\n     2 3 2 3 2 3 2 3 1\n4 1 -1.0 -3 u=2\n5 0 3 u=2 *fill=4 (0.25 0 0 90 0 90 180 90 90 90 90 0)\n6 2 -1.0 -4 u=3 "), ring,
        F.lit("\n7 0 4 u=3\n8 0 -5 u=4\n9 0 5 u=4 imp:n=1\n\n1 rpp -2 2 -2 2 -1 1\n2 rpp -0.5 0.5 -0.5 0.5 -3 3\n3 cz "), r, F.lit("\n4 so "), r, F.lit("\n5 px 0.1\n\nm1 1001 1.0\n"),
    )
    return m.t("part").select(F.col("p_partkey").cast("string").alias("deck"), text.alias("value"))


@query("""with p as (select l_partkey::varchar deck, l_partkey k, (l_quantity - 25) / 11 + 0.013::double x, l_discount * 40 - 2.01::double y, l_tax * 30 - 1.11::double z, (p_size % 4 + 1) * 0.1::double r from lineitem join part on l_partkey = p_partkey),
    e as (select *, floor(x + 0.5)::int i, floor(y + 0.5)::int j from p), f as (select *, x - i u, y - j v from e),
    g as (select *, abs(x) < 2 and abs(y) < 2 and abs(z) < 1 world, abs(i) <= 1 and abs(j) <= 1 element, i = 1 and j = 1 bare, (i + j) % 2 = 0 pin from f),
    h as (select *, case when not world then '2' when k % 10 = 0 then '!' when not element then '' when bare then '1,3' when pin and u * u + v * v < r * r then '1,3,4' when pin and v < 0.1::double then '1,3,5,8' when pin then '1,3,5,9'
          when u * u + v * v + z * z < r * r then '1,3,6' else '1,3,7' end path from g)
    select deck, case when path in ('!', '') then '1' else path end path, (case path when '!' then 10 when '' then 22 else 0 end)::int status, case when path not in ('!', '') then string_split(path, ',')[-1]::int end cell, count(*) n from h group by all""")
def deck_universes(m):
    """Line items as points, each followed down the universes and lattices of the deck of its part."""
    at = m.t("lineitem").select(F.col("l_partkey").cast("string").alias("deck"), ((F.col("l_quantity") - 25) / 11 + 0.013).alias("x"), (F.col("l_discount") * 40 - 2.01).alias("y"), (F.col("l_tax") * 30 - 1.11).alias("z"))
    known = at.join(shuffled(m.t("part").select(F.col("p_partkey").cast("string").alias("deck"))), "deck", "left_semi")
    found = universes.locate(known, _nested_decks(m))
    return found.groupBy("deck", F.array_join(F.col("path").cast("array<string>"), ",").alias("path"), F.col("status").cast("int").alias("status"), "cell").agg(F.count("*").alias("n"))
