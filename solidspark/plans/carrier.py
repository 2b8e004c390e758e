"""The modelling operators applied to the driver's tables, with the same in SQL.

The tables only carry the operators: volumes are regions, surfaces nations, curves customers, vertices orders;
points are the first three components of embeddings; sense uses come from line items (A, R, N as forward,
reverse, unknown), tag writes from events, groups from market segments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from solidspark import errors
from solidspark.functions import affine
from solidspark.functions.solid import Brick, Cone, Cylinder, Solid, Sphere, Torus, signed_distance
from solidspark.operators import entities, mesh, sets, tags, topology
from solidspark.sources import deck, files

#: Handles of the carriers start here, so that they do not meet.
BASE = {"volume": 0, "surface": 1_000, "curve": 1_000_000, "vertex": 1_000_000_000_000}
TOL, TOL_MERGE = 0.02, 0.01


class Carrier:
    """The carrier model over one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def t(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def entity(self) -> DataFrame:
        parts = [("region", "r_regionkey", 3, "volume"), ("nation", "n_nationkey", 2, "surface"), ("customer", "c_custkey", 1, "curve"), ("orders", "o_orderkey", 0, "vertex")]
        out = None
        for table, key, dim, kind in parts:
            one = self.t(table).select((F.col(key).cast("long") + BASE[kind]).alias("ent_id"), F.lit(dim).alias("dim"))
            out = one if out is None else out.unionByName(one)
        return out

    def points(self) -> DataFrame:
        return self.t("embeddings").select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate("xyz")])

    def uses(self) -> DataFrame:
        flag = F.col("l_returnflag")
        return self.t("lineitem").select(F.col("l_orderkey").alias("child_id"), F.col("l_suppkey").alias("parent_id"), F.when(flag == "N", "U").otherwise(flag).alias("use_sense"), F.lit("A").alias("geom_sense"))

    def conn(self) -> DataFrame:
        """Elements: the parts of an order in order of line."""
        lines = self.t("lineitem").groupBy(F.col("l_orderkey").alias("eh")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("ls"))
        return lines.select("eh", F.transform("ls", lambda s: s.getField("l_partkey")).alias("conn"))

    def groups(self) -> DataFrame:
        """Customers' segments as groups; the names of a group are the segment and its nations, some groups have none."""
        c = self.t("customer")
        names = F.when(F.col("c_custkey") % 7 == 0, F.array().cast("array<string>")).when(F.col("c_custkey") % 2 == 0, F.array("c_mktsegment", "c_name")).otherwise(F.array(F.concat("c_name", F.lit("/"), "c_mktsegment", F.lit("/"), "c_name")))
        return c.select(F.col("c_custkey").alias("group_id"), names.alias("names"))

    def writes(self) -> DataFrame:
        return self.t("events").select(F.col("user_id").alias("ent_id"), F.col("event_type").alias("handle"), "value", F.col("event_id").alias("seq"))


def _xyz(out: tuple[Column, Column, Column], *keep: str) -> list:
    return [*keep, *[c.alias(n) for c, n in zip(out, "xyz", strict=True)]]


def _p() -> tuple[Column, Column, Column]:
    return F.col("x"), F.col("y"), F.col("z")


QUERIES: dict[str, Callable[[Carrier], DataFrame]] = {}
SQL: dict[str, str] = {}

ENTITY = f"""entity as (select r_regionkey::bigint + {BASE["volume"]} ent_id, 3 dim from region union all select n_nationkey::bigint + {BASE["surface"]}, 2 from nation
    union all select c_custkey + {BASE["curve"]}, 1 from customer union all select o_orderkey + {BASE["vertex"]}, 0 from orders)"""
POINTS = "points as (select vec_id, label, embedding[1]::double x, embedding[2]::double y, embedding[3]::double z from embeddings)"
USES = "uses as (select l_orderkey child_id, l_suppkey parent_id, case when l_returnflag = 'N' then 'U' else l_returnflag end u, 'A' g from lineitem)"
SENSE = f"{USES}, sense as (select child_id, parent_id, 1 sense from uses where u = 'U' or u = g union all select child_id, parent_id, -1 from uses where u = 'U' or u <> g)"
CONN = "conn as (select l_orderkey eh, list(l_partkey order by l_linenumber, l_partkey) c from lineitem group by 1)"
SIDES = f"{CONN}, places as (select eh, c, unnest(range(len(c))) i from conn where len(c) > 1), sides as (select eh, least(c[i + 1], c[(i + 1) % len(c) + 1]) a, greatest(c[i + 1], c[(i + 1) % len(c) + 1]) b from places)"
GROUPS = "ent_group as (select c_custkey group_id, case when c_custkey % 7 = 0 then []::varchar[] when c_custkey % 2 = 0 then [c_mktsegment, c_name] else [c_name || '/' || c_mktsegment || '/' || c_name] end names from customer)"
NEAR = "select a.vec_id a, b.vec_id b from points a join points b on a.vec_id < b.vec_id and (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) < {tol} * {tol}"


def query(sql: str | None = None):
    def keep(f: Callable[[Carrier], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


#: A deck of our own: a shell around a ball, and what lies outside.
DECK = """Ball, shell and the rest
c cells: id, material, density, region
10 3 -7.8 -1 imp:p=2
20 4 -0.9 -2 1 $ the shell
     imp:p=1
30 0 2 imp:p=0

1 so 0.75
2 so 1.5

m3 26056 1.0
m4 1001 0.25 6012 0.75
mode p
"""


@query(f"with {POINTS}, r as (select 25 * (x * x + y * y + z * z) r2 from points) select (case when r2 < 0.5625 then 10 when r2 < 2.25 and r2 > 0.5625 then 20 when r2 > 2.25 then 30 end)::int cell, count(*) n from r group by 1")
def csg_cells(m: Carrier) -> DataFrame:
    """Cells of a deck, read from its text, over points, five times as far out: the flagship."""
    cards = deck.cards_of(m.spark.createDataFrame([("own", DECK)], "deck string, value string"))
    cell_rows, surface_rows = deck.cells(cards).orderBy("cell_id").collect(), deck.surfaces(cards).collect()  # one deck of a few cards
    x, y, z = (F.col(c) * 5 for c in "xyz")
    return m.points().groupBy(deck.cell_of(x, y, z, cell_rows, surface_rows).alias("cell")).agg(F.count("*").alias("n"))


def _decks(m: Carrier) -> DataFrame:
    """A deck for each part: two cells and a sphere, with comments and a continued line."""
    size, key = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    text = F.concat(F.lit("part "), key, F.lit("\nc note\n1 0 -7 $ inside\n"), F.lit("2 "), size, F.lit(" -1.5 7\n     imp:n="), size, F.lit("\n\n7 SO "), size, F.lit("\n\nM"), size, F.lit(" 1001 0.5 8016 0.5\nNPS "), key, F.lit("\n"))
    return m.t("part").select(key.alias("deck"), text.alias("value"))


@query("""select p_partkey::varchar deck, 1 cell_id, 0 material_id, null::double density, '-7' region, '' imp from part
    union all select p_partkey::varchar, 2, p_size::int, -1.5, '7', p_size::varchar from part""")
def deck_cells(m):
    found = deck.cells(deck.cards_of(_decks(m)))
    return found.select("deck", "cell_id", "material_id", "density", F.array_join("region", " ").alias("region"), F.coalesce(F.try_element_at("params", F.lit("imp:n")), F.lit("")).alias("imp"))


@query("select p_partkey::varchar deck, 7 surface_id, 'so' mnemonic, p_size::double radius from part")
def deck_surfaces(m):
    return deck.surfaces(deck.cards_of(_decks(m))).select("deck", "surface_id", "mnemonic", F.get("params", F.lit(0)).alias("radius"))


@query("select p_partkey::varchar deck, p_size::int material_id, o::int ord, z::int zaid, 0.5::double fraction from part, (values (0, 1001), (1, 8016)) v(o, z)")
def deck_materials(m):
    return deck.materials(deck.cards_of(_decks(m)))


@query("select p_partkey::varchar deck, 1 ord, 'nps' keyword, p_partkey::varchar args from part")
def deck_params(m):
    return deck.params(deck.cards_of(_decks(m))).select("deck", "ord", "keyword", F.array_join("args", " ").alias("args"))


@query(f"with {ENTITY} select dim::int dim, count(*) n from entity group by 1")
def num_of_type(m):
    return entities.num_of_type(m.entity())


@query(f"with {ENTITY} select coalesce(dim, 4)::int dim, count(*) n from entity group by rollup(dim)")
def num_of_type_all(m):
    return entities.num_of_type_all(m.entity())


@query(f"with {ENTITY} select ent_id, dim::int dim from entity where dim = 2")
def get_entities_by_type(m):
    return entities.of_type(m.entity(), 2)


@query(f"with {ENTITY} select ent_id, dim::int dim from entity where dim = 1 and ent_id - {BASE['curve']} in (select c_custkey from customer where c_mktsegment = 'BUILDING')")
def get_entities_in_set(m):
    members = m.t("customer").where("c_mktsegment = 'BUILDING'").select(F.lit(1).cast("long").alias("group_id"), (F.col("c_custkey") + BASE["curve"]).alias("member_id"), F.lit("entity").alias("member_kind"))
    return entities.in_set(m.entity(), members, 1, 1)


@query(f"with {ENTITY} select ent_id, dim::int dim from entity e where not exists (select 1 from nation where n_nationkey + {BASE['surface']} = e.ent_id)")
def not_type_filter(m):
    return entities.not_of_type(m.entity(), entities.of_type(m.entity(), 2))


@query("""select n_regionkey::bigint parent_id, n_nationkey::bigint + 1000 child_id, 3 parent_dim from nation
    union all select c_nationkey::bigint + 1000, c_custkey + 1000000, 2 from customer union all select o_custkey + 1000000, o_orderkey + 1000000000000, 1 from orders""")
def topology_links(m):
    n, c, o = m.t("nation"), m.t("customer"), m.t("orders")
    up = lambda df, p, pk, k, kk: df.select((F.col(p).cast("long") + BASE[pk]).alias("parent_id"), (F.col(k).cast("long") + BASE[kk]).alias("child_id"))
    uses = up(n, "n_regionkey", "volume", "n_nationkey", "surface").union(up(c, "c_nationkey", "surface", "c_custkey", "curve")).union(up(o, "o_custkey", "curve", "o_orderkey", "vertex"))
    return topology.links(uses, m.entity())


@query("select o_orderkey child_id, o_custkey parent_id from orders o where not exists (select 1 from customer where c_custkey % 2 = 0 and c_custkey = o.o_custkey)")
def topology_orphans(m):
    kids = m.t("orders").select(F.col("o_orderkey").alias("child_id"), F.col("o_custkey").alias("parent_id"))
    return topology.orphans(kids, m.t("customer").where("c_custkey % 2 = 0"), "parent_id", "c_custkey").select("child_id", "parent_id")


@query(f"with {SENSE} select child_id, parent_id, sense::int sense from sense")
def surface_senses(m):
    return topology.surface_senses(m.uses())


@query(f"with {SENSE} select child_id, sense::int sense, count(*) n_uses from sense group by all having count(*) > 1")
def sense_violations(m):
    return topology.sense_violations(topology.senses(m.uses()))


@query(f"with {SENSE} select child_id, sense::int sense, count(*) n_parents, string_agg(parent_id::varchar, ',' order by parent_id) parents from sense group by 1, 2")
def curve_senses(m):
    return topology.curve_senses(m.uses()).select("child_id", "sense", F.size("parents").cast("long").alias("n_parents"), F.array_join(F.col("parents").cast("array<string>"), ",").alias("parents"))


@query("select user_id ent_id, event_type handle, arg_max(value, event_id) as value from events group by 1, 2")
def tag_upsert(m):
    return tags.upsert(m.writes(), "seq")


PRESETS = "presets(name, handle) as (values ('NAME', -1), ('GLOBAL_ID', -2), ('UNIQUE_ID', -3), ('MESH_INTERVAL', -4), ('MESH_SIZE', -5), ('SIZE_FIRMNESS', -6))"


@query(f"with {PRESETS}, w as (select distinct event_type name from events union all select name from presets) select w.name, coalesce(handle, 0)::int handle, (case when handle is null then 14 else 0 end)::int status from w left join presets using (name)")
def tag_lookup_missing(m):
    registry = tags.registry(m.spark)
    wanted = m.t("events").select(F.col("event_type").alias("name")).distinct().union(registry.select("name"))
    return tags.handles(registry, wanted)


@query("select event_id, (-(event_id % 8))::int handle, (case when event_id % 8 in (0, 1) then 0 else 21 end)::int status from events")
def tag_preset_status(m):
    handle = (-(F.col("event_id") % 8)).cast("int")
    return m.t("events").select("event_id", handle.alias("handle"), tags.preset_status(handle).cast("int").alias("status"))


@query("""with last as (select user_id ent_id, event_type name, arg_max(value, event_id) v from events group by 1, 2),
    h as (select name, row_number() over (order by name) handle from (select distinct event_type name from events)),
    t as (select ent_id, name, handle, round(v * 100)::bigint::varchar v from last join h using (name))
    select ent_id, 'TAGS,' || string_agg(name, ',' order by handle) strings, count(*) n_tags, string_agg(name || '=' || hex(v), ',' order by name) as values from t group by 1""")
def tag_pack(m):
    """Packed, and unpacked again: the values as they come back."""
    names = m.t("events").select(F.col("event_type").alias("name")).distinct()  # a registry: a few names
    registry = names.select(F.row_number().over(Window.orderBy("name")).alias("handle"), "name")
    last = tags.upsert(m.writes(), "seq").withColumnRenamed("handle", "name").join(F.broadcast(registry), "name")
    values = last.select("ent_id", "handle", F.round(F.col("value") * 100).cast("long").cast("string").cast("binary").alias("value"))
    packed = tags.pack(values, registry)
    shown = F.concat("name", F.lit("="), F.hex("value"))
    back = tags.unpack(packed).groupBy("ent_id").agg(F.array_join(F.array_sort(F.collect_list(shown)), ",").alias("values"), F.count("*").alias("n_tags"))
    return packed.select("ent_id", F.array_join("strings", ",").alias("strings")).join(back, "ent_id")


@query(f"with {GROUPS} select group_id, substr(names[1], 1, 31) as name, length(names[1]) > 31 truncated from ent_group where len(names) > 0")
def group_names_truncated(m):
    return sets.group_names(m.groups(), 32)


@query(f"with {GROUPS}, slots as (select group_id, names, unnest(range(len(names))) slot from ent_group where len(names) > 1) select group_id, slot::int slot, names[slot + 1] as name from slots")
def extra_names(m):
    return sets.extra_names(m.groups())


@query(f"""select n_regionkey::bigint group_id, n_nationkey::bigint + {BASE["surface"]} handle from nation union
    select n_regionkey::bigint, r_regionkey::bigint from nation join region on n_regionkey = r_regionkey union
    select c_nationkey::bigint, c_custkey + {BASE["curve"]} from customer union select n_nationkey::bigint, n_regionkey::bigint from nation""")
def group_content(m):
    n, c = m.t("nation"), m.t("customer")
    row = lambda df, g, member, kind: df.select(F.col(g).cast("long").alias("group_id"), member.cast("long").alias("member_id"), F.lit(kind).alias("member_kind"))
    members = row(n, "n_regionkey", F.col("n_nationkey") + BASE["surface"], "entity").union(row(n, "n_regionkey", F.col("n_regionkey"), "body"))
    members = members.union(row(c, "c_nationkey", F.col("c_custkey") + BASE["curve"], "entity")).union(row(n, "n_nationkey", F.col("n_regionkey"), "group")).union(row(n, "n_nationkey", F.col("n_nationkey") + 10**9, "entity"))
    groups = m.t("region").select(F.col("r_regionkey").cast("long").alias("group_id"))
    bodies = m.t("region").select(F.col("r_regionkey").cast("long").alias("body_id"), F.col("r_regionkey").cast("long").alias("volume_id"))
    return sets.group_content(members, groups, m.entity(), bodies)


@query(f"with {POINTS} select label, min(x) min_x, min(y) min_y, min(z) min_z, max(x) max_x, max(y) max_y, max(z) max_z from points group by 1")
def bbox_by_label(m):
    return entities.bounding_boxes(m.points(), "label")


@query(f"with {POINTS} select vec_id, x + 1.0::double x, y + -2.0::double y, z + 0.5::double z from points")
def move(m):
    return m.points().select(*_xyz(affine.move(_p(), 1, -2, 0.5), "vec_id"))


@query(f"with {POINTS} select vec_id, 1.0::double + (x - 1.0::double) * 2.0::double x, 0.0::double + (y - 0.0::double) * -1.0::double y, 0.25::double + (z - 0.25::double) * 0.5::double z from points")
def scale(m):
    return m.points().select(*_xyz(affine.scale(_p(), (1, 0, 0.25), (2, -1, 0.5)), "vec_id"))


@query(f"""with {POINTS}, d as (select *, 0.0::double + (x - 0.5::double) * 1.0::double + (y - 0.0::double) * 2.0::double + (z - 0.0::double) * 2.0::double d from points)
    select vec_id, x - 2.0::double * d / 9.0::double * 1.0::double x, y - 2.0::double * d / 9.0::double * 2.0::double y, z - 2.0::double * d / 9.0::double * 2.0::double z from d""")
def reflect(m):
    return m.points().select(*_xyz(affine.reflect(_p(), (0.5, 0, 0), (1, 2, 2)), "vec_id"))


@query(f"""with {POINTS}, k as (select cos(radians(30)) c, sin(radians(30)) s) select vec_id, round(x * c - y * s, 9) + 0 x, round(x * s + y * c, 9) + 0 y, round(z, 9) + 0 z from points, k""")
def rotate(m):
    out = affine.rotate(_p(), 30, (0, 0, 1))
    return m.points().select(*_xyz(tuple(F.round(c, 9) + 0 for c in out), "vec_id"))


A, B = Sphere(0.25), Sphere(0.25).moved(0.125, 0, 0)  # expressions are made when a query asks
IN_A, IN_B = "x * x + y * y + z * z <= 0.0625::double", "(x + -0.125::double) * (x + -0.125::double) + y * y + z * z <= 0.0625::double"


def _inside(m: Carrier, solid: Solid) -> DataFrame:
    return m.points().where(solid.contains(*_p())).select("vec_id", "label")


@query(f"with {POINTS} select vec_id, label from points where {IN_A} or {IN_B}")
def csg_unite(m):
    return _inside(m, A | B)


@query(f"with {POINTS} select vec_id, label from points where {IN_A} and not ({IN_B})")
def csg_subtract(m):
    return _inside(m, A - B)


@query(f"with {POINTS} select vec_id, label from points where {IN_A} and {IN_B}")
def csg_intersect(m):
    return _inside(m, A & B)


@query(f"with {POINTS} select vec_id, (x * 3.0::double + y * 0.0::double + z * 4.0::double) / 5.0::double dist from points where (x * 3.0::double + y * 0.0::double + z * 4.0::double) / 5.0::double >= 0.0625::double")
def section_plane(m):
    d = signed_distance(_p(), (3, 0, 4))
    return m.points().where(d >= F.lit(0.0625)).select("vec_id", d.alias("dist"))


@query(f"""with {POINTS} select vec_id, abs(x) <= 0.125::double and abs(y) <= 0.25::double and abs(z) <= 0.125::double brick,
    (x / 0.25::double) * (x / 0.25::double) + (y / 0.125::double) * (y / 0.125::double) <= 1.0::double and abs(z) <= 0.25::double cylinder,
    (x / 0.25::double) * (x / 0.25::double) + (y / 0.25::double) * (y / 0.25::double) <= (1.0::double + -0.5::double * (z + 0.25::double) / 0.5::double) * (1.0::double + -0.5::double * (z + 0.25::double) / 0.5::double) and abs(z) <= 0.25::double cone,
    x * x + y * y + z * z <= 0.0625::double sphere,
    (sqrt(x * x + y * y) - 0.25::double) * (sqrt(x * x + y * y) - 0.25::double) + z * z <= 0.015625::double torus from points""")
def primitive_membership(m):
    solids = {"brick": Brick(0.25, 0.5, 0.25), "cylinder": Cylinder(0.5, 0.25, 0.125), "cone": Cone(0.5, 0.25, 0, 0.125), "sphere": Sphere(0.25), "torus": Torus(0.25, 0.125)}
    return m.points().select("vec_id", *[s.contains(*_p()).alias(n) for n, s in solids.items()])


@query("""with o as (select l_orderkey, l_partkey, row_number() over w - 1 ord, lead(l_partkey) over w nxt from lineitem window w as (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey))
    select l_orderkey curve_id, ord::int ord, l_partkey a, nxt b from o where nxt is not null""")
def curve_edges(m):
    return mesh.curve_edges(m.t("lineitem"), "l_orderkey", "l_partkey", "l_linenumber", "l_partkey", "l_suppkey").withColumn("ord", F.col("ord").cast("int"))


@query(f"with {CONN} select eh, case len(c) when 3 then 'TRI' when 4 then 'QUAD' else 'POLYGON' end as type from conn")
def facet_types(m):
    return m.conn().select("eh", mesh.facet_type(F.size("conn")).alias("type"))


@query(f"""with {CONN}, s as (select eh // 100 surface_id, eh, c from conn), o as (select *, row_number() over (partition by surface_id order by eh) - 1 ord from s)
    select surface_id, ord::int ord, case len(c) when 3 then 'TRI' when 4 then 'QUAD' else 'POLYGON' end as type, array_to_string(list_transform(c, lambda v: v % 64), ',') conn from o""")
def facet_decode(m):
    flat = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("eh", "conn"))), lambda s: F.concat(F.array(F.size(s.getField("conn"))), F.transform(s.getField("conn"), lambda v: (v % 64).cast("int")))))
    lists = m.conn().groupBy(F.floor(F.col("eh") / 100).alias("surface_id")).agg(flat.alias("facet_list"))
    point = F.struct(*[F.lit(0.0).alias(c) for c in "xyz"])
    found = mesh.facets(lists.withColumn("points", F.array_repeat(point, 64)))
    return found.select("surface_id", "ord", "type", F.array_join(F.col("conn").cast("array<string>"), ",").alias("conn"))


@query(f"with {POINTS} {NEAR.format(tol=f'{TOL}::double')}")
def coincident_vertices(m):
    return mesh.coincident(m.points(), TOL, "vec_id")


@query(f"""with recursive {POINTS}, near as ({NEAR.format(tol=f'{TOL_MERGE}::double')}), both_ways as (select a, b from near union all select b, a from near),
    reach as (select vec_id a, vec_id b from points union select r.a, n.b from reach r join both_ways n on r.b = n.a) select a vec_id, min(b) keep from reach group by 1""")
def vertex_merge(m):
    return mesh.merge_vertices(m.points(), TOL_MERGE, "vec_id")


@query(f"with {CONN} select eh, min(eh) over (partition by list_sort(c)) keep from conn")
def face_merge(m):
    return mesh.merge_faces(m.conn())


@query(f"with {SIDES} select a, b, count(*) n from sides group by 1, 2 having count(*) <> 2")
def open_edges(m):
    return mesh.open_edges(m.conn())


@query(f"with {ENTITY} select ent_id, dim::int dim from entity where ent_id not in (select o_orderkey + {BASE['vertex']} from orders where o_orderstatus = 'F') and not (dim = 3 and ent_id = 2) and not (dim = 3 and ent_id in (select r_regionkey from region where r_regionkey = 3))")
def delete_cascade(m):
    gone = m.t("orders").where("o_orderstatus = 'F'").select((F.col("o_orderkey") + BASE["vertex"]).alias("ent_id")).union(m.spark.range(2, 3).toDF("ent_id"))
    bodies = m.t("region").select((F.col("r_regionkey").cast("long") - F.col("r_regionkey").cast("long") % 2 + 10**15).alias("body_id"), F.col("r_regionkey").cast("long").alias("volume_id"))
    return entities.delete(m.entity(), gone, bodies)


@query("""with n as (select p_partkey, p_name || case p_partkey % 6 when 0 then '.igs' when 1 then '.STEP' when 2 then '.sat.gz' when 3 then '.brep' when 4 then '.txt' else '.Sat' end f from part)
    select p_partkey, case when contains(f, '.igs') or contains(f, '.IGS') or contains(f, '.iges') or contains(f, '.IGES') then 'IGES' when contains(f, '.stp') or contains(f, '.STP') or contains(f, '.step') or contains(f, '.STEP') then 'STEP'
    when contains(f, '.sat') or contains(f, '.SAT') then 'ACIS_SAT' when contains(f, '.occ') or contains(f, '.OCC') or contains(f, '.brep') or contains(f, '.BREP') then 'OCC' else 'NOT_DEFINED' end file_type from n""")
def file_type(m):
    k = F.col("p_partkey") % 6
    end = F.when(k == 0, ".igs").when(k == 1, ".STEP").when(k == 2, ".sat.gz").when(k == 3, ".brep").when(k == 4, ".txt").otherwise(".Sat")
    return m.t("part").select("p_partkey", F.coalesce(files.type_of_name(F.concat("p_name", end)), F.lit("NOT_DEFINED")).alias("file_type"))


@query(f"with {ENTITY} select dim::int dim, count(*) filter (where ent_id % 10 = 0) n_failed, count(*) n_total from entity where dim in (1, 2) group by 1")
def faceting_report(m):
    return mesh.faceting_report(m.entity().where("dim in (1, 2)").select("dim", (F.col("ent_id") % 10 == 0).alias("failed")))


@query(f"with {ENTITY} select 7::bigint set_id, ent_id handle, 'ent_id' kind from entity union all select 7, vec_id, 'vec_id' from embeddings")
def file_set(m):
    return entities.file_set((m.entity(), "ent_id"), (m.points(), "vec_id"), set_id=7)


@query("""with o as (select p_partkey, ';TYPE=' || p_brand || ';SIZE=' || p_size::varchar || ';tail' s from part)
    select p_partkey, 2::bigint n_tokens, 'TYPE=' || substr(s, 7, position(';' in substr(s, 7)) - 1) as first, substr(s, 7, position(';' in substr(s, 7)) - 1) type_value from o""")
def option_tokens(m):
    o = F.concat(F.lit(";TYPE="), "p_brand", F.lit(";SIZE="), F.col("p_size").cast("string"), F.lit(";tail"))
    t = m.t("part").select("p_partkey", files.tokenize(o).alias("t"))
    first = F.get("t", F.lit(0))
    return t.select("p_partkey", F.size("t").cast("long").alias("n_tokens"), first.alias("first"), files.match_option(first, "TYPE").alias("type_value"))


BODIES = f"bodies as (select (r_regionkey - r_regionkey % 2)::bigint + {10**15} body_id, r_regionkey::bigint volume_id from region where r_regionkey < 4)"


def _bodies(m: Carrier) -> DataFrame:
    """Two volumes a body; the last region has none."""
    key = F.col("r_regionkey").cast("long")
    return m.t("region").where("r_regionkey < 4").select((key - key % 2 + 10**15).alias("body_id"), key.alias("volume_id"))


@query(f"""with {ENTITY}, {BODIES}, all_of as (select dim from entity where dim <> 3 union all select 3 from (select distinct coalesce(body_id, ent_id) from entity left join bodies on ent_id = volume_id where dim = 3))
    select coalesce(dim, 4)::int dim, count(*) n from all_of group by rollup(dim)""")
def num_of_type_bodies(m):
    return entities.num_of_type_bodies(m.entity(), _bodies(m))


@query(f"with {ENTITY} select d::int dim, (select count(*) from entity where dim < 3 and (d = 4 or dim = d)) + case when d in (3, 4) then (select count(distinct r_regionkey // 2) from region) else 0 end n from range(5) t(d)")
def count_in_list(m):
    """A list of all but the volumes, of bodies, and of groups, which do not count."""
    own = m.entity().where("dim < 3").select(F.lit("entity").alias("kind"), "dim")
    more = m.t("region").select(F.floor(F.col("r_regionkey") / 2).alias("b")).distinct().select(F.lit("body").alias("kind"), F.lit(None).cast("int").alias("dim"))
    items = own.union(more).union(m.t("customer").select(F.lit("group"), F.lit(None).cast("int")))
    out = None
    for dim in range(5):
        one = entities.count_in_list(items, dim).select(F.lit(dim).alias("dim"), "n")
        out = one if out is None else out.union(one)
    return out


@query(f"""with {ENTITY}, c as (select ent_id, row_number() over (order by ent_id) k from entity where dim = 2)
    select ent_id, dim::int dim, (ent_id % 1000)::int global_id from entity union all select (select max(ent_id) from entity) + k, 2, (ent_id % 1000)::int from c""")
def copy_entities(m):
    """Copies take ids after the largest, in order of the old ones, which their other columns show."""
    return entities.copy(m.entity().withColumn("global_id", (F.col("ent_id") % 1000).cast("int")), entities.of_type(m.entity(), 2))


@query("select distinct g group_id, k member_id, 'entity' member_kind from (select c_custkey % 3 g, c_custkey k from customer where c_custkey % 5 > 0 union all select g, 7 from range(3) t(g) union all select 0, 8)")
def add_to_set(m):
    """Members that are added twice are there once."""
    out = m.t("customer").where("c_custkey % 5 > 0").select((F.col("c_custkey") % 3).alias("group_id"), F.col("c_custkey").alias("member_id"), F.lit("entity").alias("member_kind"))
    for group, member in ((0, 7), (1, 7), (2, 7), (0, 8), (0, 8)):
        out = sets.add_to_set(out, group, member)
    return out


@query("select (select max(c_custkey) from customer) + 1 group_id, 'made' as name union all select c_custkey, 'Customer' from customer where c_custkey <= 3")
def create_set(m):
    groups = m.t("customer").select(F.col("c_custkey").alias("group_id"), F.array(F.lit("Customer")).alias("names"))
    out, new = sets.create_set(groups, ["made"])
    return out.where((F.col("group_id") <= 3) | (F.col("group_id") == new)).select("group_id", F.element_at("names", 1).alias("name"))


@query(f"""with {PRESETS}, named as (select distinct c_mktsegment as name from customer), made as (select name, row_number() over (order by name) handle from named)
    select name, handle::int handle, (select count(*) from customer where c_mktsegment = name) n_uses from (select * from presets union all select * from made)""")
def create_tags(m):
    """A tag for every segment of the customers, in order of names, and how many use it."""
    used = m.t("customer").groupBy(F.col("c_mktsegment").alias("name")).agg(F.count("*").alias("n_uses"))
    reg = tags.registry(m.spark)
    for r in used.orderBy("name").collect():  # a registry: a few names
        reg, _ = tags.create_tag(reg, r.name, 8, "DOUBLE")
    return reg.join(used, "name", "left").select("name", "handle", F.coalesce("n_uses", F.lit(0)).alias("n_uses"))


@query("select event_id, (-(event_id % 8))::int handle, (case event_id % 8 when 1 then 32 when 2 then 4 when 3 then 4 when 4 then 4 when 5 then 8 when 6 then 4 else 0 end)::int length from events")
def tag_sizes(m):
    wanted = m.t("events").select("event_id", (-(F.col("event_id") % 8)).cast("int").alias("handle"))
    return tags.sizes(tags.registry(m.spark), wanted).select("event_id", "handle", F.coalesce("length", F.lit(0)).alias("length"))


@query("""select o_orderkey * 10 + k ent_id, 5 handle, hex(lpad((o_orderkey % 1000 + k)::varchar, 4, '0')) as value, k::bigint seq from orders, range(3) r(k)""")
def tag_set_array(m):
    key = F.col("o_orderkey")
    four = lambda k: F.lpad((key % 1000 + k).cast("string"), 4, "0")
    targets = m.t("orders").select(F.array(*[key * 10 + k for k in range(3)]).alias("ent_ids"), F.concat(*map(four, range(3))).cast("binary").alias("values"))
    return tags.set_array(targets, 5, 4).withColumn("value", F.hex("value"))


@query("select user_id ent_id, event_type handle, arg_max(value, event_id) as value from events where user_id % 3 <> 0 group by 1, 2")
def tag_clear(m):
    return tags.clear(tags.upsert(m.writes(), "seq"), m.t("events").where("user_id % 3 = 0").select(F.col("user_id").alias("ent_id")))


@query("select distinct user_id ent_id from events where event_type <> 'click'")
def tag_prune(m):
    return tags.with_values(m.writes().where("handle <> 'click'"))


@query("select c_custkey ent_id, (select count(distinct event_type) from events where user_id = c_custkey)::bigint n_tags from customer")
def tag_attributes(m):
    return tags.attributes(m.t("customer").select(F.col("c_custkey").alias("ent_id")), tags.upsert(m.writes(), "seq"))


@query("select user_id % 50 group_id, event_type handle, arg_max(value, event_id) as value from events group by 1, 2")
def set_tag_upsert(m):
    """Values on sets."""
    return tags.upsert(m.writes().withColumn("group_id", F.col("ent_id") % 50), "seq", keys=("group_id",))


@query(f"""with {ENTITY}, {GROUPS} select ent_id handle, dim::int GEOM_DIMENSION, (ent_id % 1000)::int GLOBAL_ID, case dim when 0 then 'Vertex' when 1 then 'Curve' when 2 then 'Surface' else 'Volume' end CATEGORY, null NAME, null::double FACETING_TOL, null::double GEOMETRY_RESABS from entity
    union all select group_id, 4, group_id::int, 'Group', substr(names[1], 1, 31), null, null from ent_group where len(names) > 0 union all select 0, -1, -1, null, null, 0.001, 1e-6""")
def export_tags(m):
    found = tags.export_tags(m.entity().withColumn("global_id", (F.col("ent_id") % 1000).cast("int")), sets.group_names(m.groups(), 32), 1e-3, 1e-6)
    return found.withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("GEOM_DIMENSION", "GLOBAL_ID")})  # the file set has none


#: Surfaces and curves of 50 vectors each, in order: as points, and every tenth as a geometric vertex of it.
PLACES = f"{POINTS}, places as (select vec_id // 50 owner_id, vec_id % 50 as ord, vec_id, x, y, z, vec_id % 10 = 0 is_vertex from points)"


def _patches(m: Carrier) -> tuple[DataFrame, DataFrame]:
    """Surfaces (surface_id, points, facet_list): strips of triangles; and their vertices (surface_id, vh, x, y, z)."""
    at = m.points().withColumn("surface_id", F.floor(F.col("vec_id") / 50))
    pts = at.groupBy("surface_id").agg(F.array_sort(F.collect_list(F.struct("vec_id", F.struct("x", "y", "z").alias("p")))).alias("v"))
    strip = F.flatten(F.transform(F.sequence(F.lit(0), F.size("v") - 3), lambda i: F.array(F.lit(3), i, i + 1, i + 2)))
    surfaces = pts.select("surface_id", F.transform("v", lambda s: s.getField("p")).alias("points"), F.when(F.size("v") >= 3, strip).otherwise(F.array().cast("array<int>")).alias("facet_list"))
    return surfaces, at.where("vec_id % 10 = 0").select("surface_id", F.col("vec_id").alias("vh"), "x", "y", "z")


@query(f"with {POINTS} select row_number() over (order by vec_id) vh, vec_id owner_id, x, y, z from points")
def create_vertices(m):
    return mesh.create_vertices(m.points().select(F.col("vec_id").alias("ent_id"), "x", "y", "z"))


#: A vertex takes the first point of its surface within the tolerance, and a point the last vertex.
MATCHED = f"""{PLACES}, near as (select v.owner_id, v.vec_id vh, min(p.ord) as ord from places v join places p on v.owner_id = p.owner_id and v.is_vertex
    and (v.x - p.x) * (v.x - p.x) + (v.y - p.y) * (v.y - p.y) + (v.z - p.z) * (v.z - p.z) < {TOL}::double * {TOL}::double group by 1, 2),
    matched as (select owner_id, ord, max(vh) vh from near group by 1, 2)"""


@query(f"with {MATCHED} select owner_id surface_id, ord::int as ord, vh from matched")
def match_points(m):
    return mesh.match_points(*_patches(m), TOL)


HANDLED = f"""{MATCHED}, fresh as (select owner_id, ord, {10**9} + row_number() over (order by owner_id, ord) vh, x, y, z from places p where not exists (select 1 from matched q where q.owner_id = p.owner_id and q.ord = p.ord)),
    handled as (select owner_id, ord, vh from fresh union all select owner_id, ord, vh from matched)"""


@query(f"with {HANDLED} select vh, owner_id, x, y, z from fresh")
def surface_vertices(m):
    return mesh.surface_mesh(*_patches(m), TOL, 10**9)[0]


@query(f"""with {HANDLED} select row_number() over (order by a.owner_id, a.ord) eh, a.owner_id, 'TRI' as type, a.vh || ',' || b.vh || ',' || c.vh conn
    from handled a join handled b on a.owner_id = b.owner_id and b.ord = a.ord + 1 join handled c on a.owner_id = c.owner_id and c.ord = a.ord + 2""")
def surface_facets(m):
    faces = mesh.surface_mesh(*_patches(m), TOL, 10**9)[1]
    return faces.withColumn("conn", F.array_join(F.col("conn").cast("array<string>"), ","))


def _curves(m: Carrier) -> DataFrame:
    """Curves over the vectors of a surface; odd ones have their geometry reversed."""
    surfaces, _ = _patches(m)
    first, odd = F.col("surface_id") * 50, F.col("surface_id") % 2 == 1
    n = F.size("points")
    a, b = first, first + n - 1
    return surfaces.where(n >= 2).select(F.col("surface_id").alias("curve_id"), F.when(odd, b).otherwise(a).alias("start_vh"), F.when(odd, a).otherwise(b).alias("end_vh"), odd.alias("reversed"), "points")


CURVES = f"""{PLACES}, n as (select owner_id, count(*) n from places group by 1 having count(*) > 1),
    turned as (select p.owner_id, case when p.owner_id % 2 = 1 then n - 1 - ord else ord end as ord, n, vec_id, x, y, z from places p join n using (owner_id)),
    inner_ones as (select owner_id, ord, {10**9} + row_number() over (order by owner_id, ord) vh, x, y, z from turned where ord > 0 and ord < n - 1),
    on_curve as (select owner_id, ord, vh from inner_ones union all select owner_id, ord, vec_id from turned where ord = 0 or ord = n - 1)"""


@query(f"with {CURVES} select vh, owner_id, x, y, z from inner_ones")
def curve_vertices(m):
    return mesh.curve_mesh(_curves(m), 1e-9, 10**9)[0]


@query(f"with {CURVES} select row_number() over (order by a.owner_id, a.ord) eh, a.owner_id, a.vh a, b.vh b from on_curve a join on_curve b on a.owner_id = b.owner_id and b.ord = a.ord + 1")
def curve_facets(m):
    edges = mesh.curve_mesh(_curves(m), 1e-9, 10**9)[1]
    return edges.select("eh", "owner_id", F.get("conn", F.lit(0)).alias("a"), F.get("conn", F.lit(1)).alias("b"))


@query(f"with {CURVES} select owner_id curve_id, 'open' status, true warn from n where owner_id % 3 = 0 union all select owner_id, 'open', false from n where owner_id % 3 <> 0")
def curve_status(m):
    """Every third curve has one vertex at both ends, though its points are open."""
    curves = _curves(m).withColumn("end_vh", F.when(F.col("curve_id") % 3 == 0, F.col("start_vh")).otherwise(F.col("end_vh")))
    return mesh.curve_status(mesh.curve_points(curves), 1e-9).select("curve_id", "status", "warn")


@query(f"with {CURVES} select owner_id curve_id from n where owner_id % 4 = 1")
def far_ends(m):
    """Every fourth curve has its ends' vertices moved away."""
    moved = F.when(F.floor(F.col("vec_id") / 50) % 4 == 1, 1.0).otherwise(0.0)
    vertices = m.points().select(F.col("vec_id").alias("vh"), (F.col("x") + moved).alias("x"), "y", "z")
    return mesh.far_ends(mesh.curve_points(_curves(m)), vertices, 1e-9)


@query(f"with {CONN}, kept as (select eh, min(eh) over (partition by list_sort(c)) keep from conn) select keep a, eh b from kept where eh <> keep")
def imprint(m):
    return mesh.imprint(m.conn())


@query("""with n as (select p_partkey, p_name || case p_partkey % 4 when 0 then '.igs' when 1 then '.txt' else '.sat' end f, case p_partkey % 5 when 0 then 'TYPE=OCC' when 1 then 'TYPE=own' when 2 then 'SIZE=1' when 3 then 'TYPE=' end o from part)
    select p_partkey, case when p_partkey % 5 = 2 then null when p_partkey % 5 = 0 then 'OCC' when p_partkey % 5 = 1 then 'NOT_DEFINED' when p_partkey % 4 = 0 then 'IGES' when p_partkey % 4 = 1 then null else 'ACIS_SAT' end file_type,
    (case when p_partkey % 5 = 2 then 19 when p_partkey % 5 > 1 and p_partkey % 4 = 1 then 22 else 0 end)::int status from n""")
def save_type(m):
    k, o = F.col("p_partkey") % 4, F.col("p_partkey") % 5
    name = F.concat("p_name", F.when(k == 0, ".igs").when(k == 1, ".txt").otherwise(".sat"))
    option = F.when(o == 0, "TYPE=OCC").when(o == 1, "TYPE=own").when(o == 2, "SIZE=1").when(o == 3, "TYPE=")
    kind, status = files.save_status(name, option)
    return m.t("part").select("p_partkey", kind.alias("file_type"), status.cast("int").alias("status"))


@query("select event_id, case event_id % 3 when 0 then '' when 1 then 'Tag does not exist' else 'Feature not supported' end as text from events")
def error_texts(m):
    code = F.when(F.col("event_id") % 3 == 0, 0).when(F.col("event_id") % 3 == 1, 14).otherwise(21)
    return m.t("events").select("event_id", errors.text_of(code).alias("text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from solidspark.plans import modelling  # noqa: F401  adds its own

    return {name: (lambda spark, sf_dir, f=f: f(Carrier(spark, sf_dir))) for name, f in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    from solidspark.plans import modelling  # noqa: F401

    return dict(SQL)
