"""Tables of a model: fixed schemas for entities, groups, mesh and decks; tags in long form."""

from __future__ import annotations

DIMENSION_NAMES = ("vertex", "curve", "surface", "body")
CATEGORY_NAMES = ("Vertex", "Curve", "Surface", "Volume", "Group")
ALL_TYPES = 4
FORWARD, REVERSE = 1, -1

TABLES = {
    "entity": "model_id string, ent_id long, dim int, category string, global_id int",
    "body_volume": "body_id long, volume_id long",
    "topology": "parent_id long, child_id long, parent_dim int",
    "sense_use": "child_id long, parent_id long, use_sense string, geom_sense string",
    "sense": "child_id long, parent_id long, sense int",
    "ent_group": "group_id long, names array<string>",
    "group_member": "group_id long, member_id long, member_kind string",
    "tag_def": "handle int, name string, value_type string, length int, default_value binary, is_active boolean",
    "tag_value": "ent_id long, handle int, value binary, seq long",
    "set_tag_value": "group_id long, handle int, value binary, seq long",
    "mesh_vertex": "vh long, owner_id long, x double, y double, z double",
    "curve_points": "curve_id long, start_vh long, end_vh long, reversed boolean, points array<struct<x:double,y:double,z:double>>",
    "surface_facets": "surface_id long, points array<struct<x:double,y:double,z:double>>, facet_list array<int>",
    "solid": "ent_id long, kind string, a double, b double, c double, d double",
    "mesh_element": "eh long, owner_id long, type string, conn array<long>",
    "model_meta": "model_id string, faceting_tol double, geometry_resabs double",
}

# Tags that every model has, with their sizes in bytes; handles count down from -1.
PRESET_TAGS = (
    ("NAME", 32, "BYTES"),
    ("GLOBAL_ID", 4, "INTEGER"),
    ("UNIQUE_ID", 4, "INTEGER"),
    ("MESH_INTERVAL", 4, "INTEGER"),
    ("MESH_SIZE", 8, "DOUBLE"),
    ("SIZE_FIRMNESS", 4, "BYTES"),
)
