"""A model: named tables and the operations over them, behind one object. Operations return new tables; nothing is
changed in place but the model's own references to its tables."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from solidspark.commands import ExportOptions
from solidspark.errors import ErrorCode, LastError, SolidError
from solidspark.operators import entities, faceting, merge, mesh, sets, tags, topology
from solidspark.schema import ALL_TYPES, TABLES
from solidspark.sources.files import resolve_save, save_tables
from solidspark.staging import stage


def recorded(operation):
    """The operation, with its outcome kept as the model's last error."""

    @wraps(operation)
    def run(self, *args, **kw):
        try:
            out = operation(self, *args, **kw)
        except SolidError as e:
            self.error.set(e.code, str(e))
            raise
        self.error.set(ErrorCode.SUCCESS)
        return out

    return run


class Model:
    def __init__(self, spark: SparkSession, model_id: str = "model", tables: dict[str, DataFrame] | None = None):
        self.spark, self.model_id, self.error = spark, model_id, LastError()
        self.tables = {n: spark.createDataFrame([], s) for n, s in TABLES.items()} | {"tag_def": tags.registry(spark)} | (tables or {})

    @classmethod
    def open(cls, spark: SparkSession, path: str, model_id: str = "model") -> Model:
        """The tables under ``path``; those that are missing are empty."""
        found = {}
        for name in TABLES:
            where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
            if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
                found[name] = spark.read.parquet(f"{path}/{name}")
        return cls(spark, model_id, found)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    root_set = None

    def get_entities(self, group_id: int | None = None, dim: int = ALL_TYPES) -> DataFrame:
        return entities.in_set(self["entity"], self["group_member"], group_id, dim)

    @recorded
    def num_of_type(self, dim: int, group_id: int | None = None) -> int:
        """Of the model: regions are bodies. Of a group: its entities, and bodies as regions; groups in it do not count."""
        if group_id is None:
            entities.check_type(dim, ErrorCode.BAD_TYPE_AND_TOPO)
            found = entities.num_of_type_bodies(self["entity"], self["body_volume"]).where(F.col("dim") == dim).first()
            return found.n if found else 0
        own = self["group_member"].where(F.col("group_id") == group_id)
        items = own.join(self["entity"].select(F.col("ent_id").alias("member_id"), "dim"), "member_id", "left").select(F.col("member_kind").alias("kind"), "dim")
        return entities.count_in_list(items, dim).first().n

    @recorded
    def bounding_box(self, ent_id: int):
        """The box of an entity's mesh vertices; of a body, that of its volumes'."""
        owners = self["body_volume"].where(F.col("body_id") == ent_id).select(F.col("volume_id").alias("owner_id")).union(self.spark.createDataFrame([(ent_id,)], "owner_id long"))
        box = entities.bounding_boxes(self["mesh_vertex"].join(owners, "owner_id", "left_semi")).first()
        if box.min_x is None:
            raise SolidError(ErrorCode.INVALID_ENTITY_HANDLE)
        return box

    def bounding_boxes(self) -> DataFrame:
        return entities.bounding_boxes(self["mesh_vertex"], "owner_id")

    @recorded
    def create_set(self, names: list[str] | None = None) -> int:
        self.tables["ent_group"], new = sets.create_set(self["ent_group"], names)
        return new

    @recorded
    def add_to_set(self, ent_id: int | None, group_id: int) -> None:
        self.tables["group_member"] = sets.add_to_set(self["group_member"], group_id, ent_id)

    @recorded
    def copy(self, ids: DataFrame) -> DataFrame:
        """Copy entities with all that they are made of; a volume's body is copied with all of its volumes. Returns (ent_id, new).

        Links, senses, meshes, curves and facets are copied with their entities; groups and tags are not."""
        wanted = ids.select("ent_id").join(self["entity"].select("ent_id"), "ent_id", "left_semi")
        bodies = self["body_volume"].join(wanted.withColumnRenamed("ent_id", "volume_id"), "volume_id", "left_semi").select("body_id").distinct()
        wanted = wanted.union(self["body_volume"].join(bodies, "body_id", "left_semi").select("volume_id"))
        new = stage(entities.new_ids(entities.below(self["topology"], wanted), entities.next_id(self["entity"])), "copied-ids")
        last = self["mesh_vertex"].agg(F.max("vh")).first()[0] or 0
        own = self["mesh_vertex"].join(new.select(F.col("ent_id").alias("owner_id")), "owner_id", "left_semi")
        handles = stage(entities.new_ids(own, last + 1, "vh"), "copied-handles")
        body = stage(entities.new_ids(bodies, (self["body_volume"].agg(F.max("body_id")).first()[0] or 0) + 1, "body_id"), "copied-bodies")

        def copied(name: str | DataFrame, ids: DataFrame, *keys: str, kept: str = "inner") -> DataFrame:
            out = self[name] if isinstance(name, str) else name
            of = ids.toDF("_o", "_n")
            for key in keys:
                out = out.join(of, out[key] == of["_o"], kept).withColumn(key, F.coalesce("_n", key)).drop("_o", "_n")
            return out

        points = copied("curve_points", new, "curve_id")
        for end in ("start_vh", "end_vh"):
            points = copied(points, handles, end, kept="left")
        more = {
            "entity": copied("entity", new, "ent_id"), "topology": copied("topology", new, "parent_id", "child_id"), "sense_use": copied("sense_use", new, "child_id", "parent_id"),
            "mesh_vertex": copied(copied("mesh_vertex", new, "owner_id"), handles, "vh"), "surface_facets": copied("surface_facets", new, "surface_id"), "solid": copied("solid", new, "ent_id"),
            "curve_points": points, "body_volume": copied(copied("body_volume", new, "volume_id"), body, "body_id"),
        }
        self.tables |= {name: self[name].unionByName(rows.select(*self[name].columns)) for name, rows in more.items()}
        return new

    #: The columns of each table that name entities.
    OWNED = {
        "topology": ("parent_id", "child_id"), "sense_use": ("child_id", "parent_id"), "sense": ("child_id", "parent_id"), "tag_value": ("ent_id",), "body_volume": ("volume_id",),
        "mesh_vertex": ("owner_id",), "mesh_element": ("owner_id",), "curve_points": ("curve_id",), "surface_facets": ("surface_id",), "solid": ("ent_id",),
    }

    @recorded
    def delete(self, ids: DataFrame) -> None:
        """The entities go with all rows of other tables that name them, a body without volumes with its memberships."""
        left = entities.delete(self["entity"], ids, self["body_volume"])
        gone = stage(self["entity"].select("ent_id").join(left.select("ent_id"), "ent_id", "left_anti"), "deleted")
        cut = {"entity": left}
        for name, keys in self.OWNED.items():
            out = self[name]
            for key in keys:
                out = out.join(gone.withColumnRenamed("ent_id", key), key, "left_anti").select(*self[name].columns)
            cut[name] = out
        bodies = self["body_volume"].select("body_id").join(cut["body_volume"].select("body_id"), "body_id", "left_anti").distinct()
        named = gone.select(F.col("ent_id").alias("member_id"), F.lit("entity").alias("member_kind")).union(bodies.select("body_id", F.lit("body")))
        cut["group_member"] = self["group_member"].join(named, ["member_id", "member_kind"], "left_anti").select(*self["group_member"].columns)
        self.tables |= cut

    def links(self) -> DataFrame:
        """(parent_id, child_id, parent_dim, sense): topology with the senses of uses, a curve's vertices by its ends; null where unknown."""
        ends = self["curve_points"].select("curve_id", F.explode(F.array(F.struct(F.col("start_vh").alias("vh"), F.lit(-1).alias("s")), F.struct(F.col("end_vh").alias("vh"), F.lit(1).alias("s")))).alias("e"))
        ends = ends.select(F.col("curve_id").alias("parent_id"), "e.vh", F.col("e.s").alias("sense")).join(self["mesh_vertex"].select("vh", F.col("owner_id").alias("child_id")), "vh")
        known = topology.senses(self["sense_use"]).unionByName(ends.select("child_id", "parent_id", "sense"))
        return self["topology"].join(known, ["parent_id", "child_id"], "left").select("parent_id", "child_id", "parent_dim", "sense")

    @recorded
    def merge(self, tol: float) -> DataFrame:
        """Merge coincident vertices, curves, surfaces and volumes; returns (ent_id, dim, keep, sense).

        What was merged away leaves all tables; links, senses and members go to what stays, whose meshes, curves and
        tags stay as they are. A side of a merged surface is then taken by both of its volumes."""
        at = self["mesh_vertex"].join(self["entity"].where("dim = 0").select(F.col("ent_id").alias("owner_id")), "owner_id", "left_semi")
        merged = stage(merge.merge_cascade(at.select(F.col("owner_id").alias("ent_id"), "x", "y", "z"), self.links(), tol), "merged")
        gone = merged.where("ent_id <> keep")
        # a use that names what is turned changes sides
        turned = merged.where("sense = -1").select(F.col("ent_id").alias("_t"))
        uses = self["sense_use"]
        for key in ("child_id", "parent_id"):
            flipped = F.when(F.col("_t").isNull() | (F.col("use_sense") == "U"), F.col("use_sense")).when(F.col("use_sense") == F.col("geom_sense"), F.concat(F.lit("-"), "geom_sense")).otherwise(F.col("geom_sense"))
            uses = uses.join(turned, uses[key] == turned["_t"], "left").withColumn("use_sense", flipped).drop("_t")
        cut = {"entity": self["entity"].join(gone.select("ent_id"), "ent_id", "left_anti").select(*self["entity"].columns)}
        for key in ("child_id", "parent_id"):
            uses = merge.relabelled(uses, merged, key)
        links = merge.relabelled(merge.relabelled(self["topology"], merged, "parent_id"), merged, "child_id")
        cut |= {"sense_use": uses, "topology": links, "group_member": merge.relabelled(self["group_member"], merged, "member_id", F.col("member_kind") == "entity"), "body_volume": merge.relabelled(self["body_volume"], merged, "volume_id")}
        for name in ("tag_value", "mesh_vertex", "mesh_element", "curve_points", "surface_facets", "solid"):
            key = self.OWNED[name][0]
            cut[name] = self[name].join(gone.select(F.col("ent_id").alias(key)), key, "left_anti").select(*self[name].columns)
        # curves end at the vertices that stay
        handle = self["mesh_vertex"].join(gone.select(F.col("ent_id").alias("owner_id"), "keep"), "owner_id").select(F.col("vh").alias("ent_id"), F.col("keep").alias("owner"))
        kept = self["mesh_vertex"].groupBy(F.col("owner_id").alias("owner")).agg(F.min("vh").alias("keep"))
        for key in ("start_vh", "end_vh"):
            cut["curve_points"] = merge.relabelled(cut["curve_points"], handle.join(kept, "owner").select("ent_id", "keep"), key)
        self.tables |= cut
        return merged

    def senses(self) -> DataFrame:
        """(child_id, parent_id, sense) of surfaces in volumes and of curves in surfaces.

        A side of a surface that is taken twice is a failure; any number of surfaces may be on a side of a curve."""
        curves = self["entity"].where("dim = 1").select(F.col("ent_id").alias("child_id"))
        uses = self["sense_use"]
        of_surfaces = topology.surface_senses(uses.join(curves, "child_id", "left_anti").select(*uses.columns), strict=True)
        return of_surfaces.unionByName(topology.senses(uses.join(curves, "child_id", "left_semi").select(*uses.columns)))

    @recorded
    def create_tag(self, name: str, length: int, value_type: str, default: bytes | None = None) -> int:
        self.tables["tag_def"], handle = tags.create_tag(self["tag_def"], name, length, value_type, default)
        return handle

    def _write(self, table: str, owner: int, handle: int, value: bytes) -> None:
        if handle < -1:
            raise SolidError(ErrorCode.NOT_SUPPORTED)
        if not self["tag_def"].where(F.col("is_active") & (F.col("handle") == handle)).limit(1).count():
            raise SolidError(ErrorCode.INVALID_TAG_HANDLE)
        seq = (self[table].agg(F.max("seq")).first()[0] or 0) + 1
        row = self.spark.createDataFrame([(owner, handle, value, seq)], TABLES[table])
        self.tables[table] = self[table].unionByName(row)

    @recorded
    def set_data(self, ent_id: int, handle: int, value: bytes) -> None:
        self._write("tag_value", ent_id, handle, value)

    @recorded
    def set_set_data(self, group_id: int, handle: int, value: bytes) -> None:
        """A value on a set."""
        self._write("set_tag_value", group_id, handle, value)

    def set_values(self) -> DataFrame:
        """(group_id, handle, value) of the sets."""
        return tags.upsert(self["set_tag_value"], "seq", keys=("group_id",))

    def data(self) -> DataFrame:
        return tags.get_data(tags.upsert(self["tag_value"], "seq"), self["tag_def"])

    def surface_vertices(self) -> DataFrame:
        """(surface_id, vh, x, y, z): the geometric vertices of each surface, over its curves."""
        down = lambda dim, parent, child: self["topology"].where(F.col("parent_dim") == dim).select(F.col("parent_id").alias(parent), F.col("child_id").alias(child))
        links = down(2, "surface_id", "curve_id").join(down(1, "curve_id", "owner_id"), "curve_id").select("surface_id", "owner_id").distinct()
        return links.join(self["mesh_vertex"], "owner_id").select("surface_id", "vh", "x", "y", "z")

    @recorded
    def save(self, path: str, options: list[str] | tuple[str, ...] = ()) -> str:
        """Write the model's tables under ``path``, and ``file_type`` with what the save resolves to (see :func:`files.resolve_save`), which is
        returned; :meth:`open` reads them back. The tables are Parquet whatever the type. A type that is none is not supported; nothing is
        overwritten: a path that is there is a write error. Nothing is written then."""
        kind = resolve_save(path, options)
        if kind == "NOT_DEFINED":
            raise SolidError(ErrorCode.NOT_SUPPORTED)
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        if where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where):
            raise SolidError(ErrorCode.FILE_WRITE_ERROR)
        tables = {n: t for n, t in self.tables.items() if n in TABLES} | {"file_type": self.spark.createDataFrame([(kind,)], "file_type string")}
        for name, table in tables.items():  # not cut by model, so that an empty one keeps its schema
            table.write.parquet(f"{path}/{name}")
        return kind

    @recorded
    def export(self, path: str, options: ExportOptions | None = None, resabs: float = 1e-6) -> DataFrame:
        """Write the model's tables with topology, senses, group names and content, curves and facets as
        elements on vertices by handle, the export's tags and the file set; returns the faceting report. A side of a surface taken twice fails before anything is written."""
        o = options or ExportOptions()
        senses = self.senses()
        curves = mesh.curve_status(mesh.curve_points(self["curve_points"]), resabs)
        if o.fatal_on_curves and curves.where("status = 'failed'").limit(1).count():
            raise SolidError(ErrorCode.FAILURE, "a curve could not be faceted")
        if mesh.facets(self["surface_facets"]).where("bad").limit(1).count():
            raise SolidError(ErrorCode.FAILURE, "bad facet list")
        base = self["mesh_vertex"].agg(F.max("vh")).first()[0] or 0
        on_curves, edges = mesh.curve_mesh(self["curve_points"], resabs, base)
        base += self["curve_points"].agg(F.sum(F.greatest(F.size("points") - 2, F.lit(0)))).first()[0] or 0
        on_surfaces, faces = mesh.surface_mesh(self["surface_facets"], self.surface_vertices(), resabs, base)
        made = on_surfaces.agg(F.max("vh")).first()[0] or base
        of_solids, shells = faceting.solid_mesh(self["solid"], o, made)
        vertices = self["mesh_vertex"].unionByName(on_curves).unionByName(on_surfaces).unionByName(of_solids)
        edge_base = self["curve_points"].agg(F.sum(F.greatest(F.size("points") - 1, F.lit(0)))).first()[0] or 0
        elements = edges.select("eh", "owner_id", F.lit("EDGE").alias("type"), "conn").unionByName(faces.withColumn("eh", F.col("eh") + edge_base))
        elements = elements.unionByName(shells.withColumn("eh", F.col("eh") + F.lit(elements.agg(F.max("eh")).first()[0] or 0)))
        status = curves.select(F.lit(1).alias("dim"), F.col("status").isin("failed", "skipped").alias("failed"))
        status = status.union(self["surface_facets"].select(F.lit(2), F.coalesce(F.size("facet_list") <= 0, F.lit(True))))
        meta = self.spark.createDataFrame([(self.model_id, o.faceting_tolerance, resabs)], TABLES["model_meta"])
        out = {
            "entity": self["entity"], "topology": self["topology"], "sense": senses, "group_name": sets.group_names(self["ent_group"]),
            "group_extra_name": sets.extra_names(self["ent_group"]), "group_content": sets.group_content(self["group_member"], self["ent_group"], self["entity"], self["body_volume"]),
            "mesh_vertex": vertices, "mesh_element": elements, "tag_def": self["tag_def"], "tag_value": self["tag_value"], "set_tag_value": self["set_tag_value"],
            "export_tag": tags.export_tags(self["entity"], sets.group_names(self["ent_group"]), o.faceting_tolerance, resabs),
            "far_end": mesh.far_ends(self["curve_points"], self["mesh_vertex"], resabs),
            "file_set": entities.file_set((self["entity"], "ent_id"), (self["ent_group"], "group_id"), (vertices, "vh"), (elements, "eh")), "model_meta": meta,
        }
        if o.make_watertight:
            # sealing is not here: what would have to be sealed is told
            sides = elements.where("type <> 'EDGE'").select("owner_id", "conn")
            own = self["entity"].where("dim = 3").select(F.col("ent_id").alias("owner_id"))
            of_volumes = mesh.closedness(sides.join(own, "owner_id", "left_semi"))
            out["closedness"] = of_volumes.unionByName(mesh.closedness(sides.join(own, "owner_id", "left_anti"), senses))
        save_tables(out, path)
        return mesh.faceting_report(status)
