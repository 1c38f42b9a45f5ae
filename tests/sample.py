"""A museum's sheet, and the mappings that turn it into objects, assets and views."""

SHEET = '''No,Within,Twin,Kind,Scan,Label,Note
1,,,Series,,"Maps, old",first drawer
2,1,,Map,vault://maps/north sea.tif,North Sea,
3,1;2,2,Map,vault://maps/zürich.tif,Zürich,"says ""Turicum"""
4,2,,Photo,vault://photos/a.jpg,Harbour,1899
5,2,4,Photo,vault://other/a.jpg,Harbour again,
6,,,Letter,,Letter without a scan,
7,99;1,,Letter,vault://letters/l 7.pdf,"Letter, torn",
8,1,,Coin,vault://coins/c.obj,Coin of no known kind,
9,3,77,Map,cellar://maps/x.tif,Map in the cellar,
'''
ROWS = 9

KINDS = {"Series": "kind/series", "Map": "kind/map", "Photo": "kind/photo", "Letter": "kind/letter"}

OBJECT = {
    "kind": [
        {"plugin": "static_map", "source": "Kind", "map": KINDS},
        {"plugin": "entity_lookup", "entity_type": "term", "bundle_key": "list", "bundle": "kinds", "value_key": "code", "ignore_case": True},
    ],
    "label": "Label",
    "note": [{"plugin": "default_value", "source": "Note", "default_value": "(none)"}],
    "_places": [
        {"plugin": "subdelimited_explode", "source": "Within", "delimiter": ";", "subdelimiter": "|", "keys": ["no"]},
    ],
    "_parents": [
        {"plugin": "get", "source": "@_places"},
        {"plugin": "sub_process", "process": {"id": [{"plugin": "get", "source": "no"}, {"plugin": "skip_on_empty", "method": "process"}, {"plugin": "migration_lookup", "migration": "object", "no_stub": True}]}},
    ],
    "parents": "@_parents",
    "twin": [
        {"plugin": "skip_on_empty", "method": "process", "source": "Twin"},
        {"plugin": "migration_lookup", "migration": "object"},
    ],
}

ASSET = {
    "_scan": [
        {"plugin": "skip_on_empty", "source": "Scan", "message": "There is no scan"},
        {"plugin": "file_is_accessible"},
    ],
    "name": [{"plugin": "callback", "source": "@_scan", "callable": "basename"}],
    "_month": [{"plugin": "default_value", "default_value": "y/n"}, {"plugin": "callback", "callable": "date"}],
    "_shelf": [{"plugin": "default_value", "default_value": "shelf:/"}],
    "_to": [
        {"plugin": "concat", "source": ["@_shelf", "@_month", "@name"], "delimiter": "/"},
        {"plugin": "urlencode"},
        {"plugin": "log", "template": "Goes to :value", "level": "info"},
    ],
    "uri": [{"plugin": "file_copy", "source": ["Scan", "@_to"]}],
    "media": [{"plugin": "callback", "source": "@_to", "callable": "mime_content_type"}],
}

VIEW = {
    "shape": [{"plugin": "static_map", "source": "Kind", "map": {"Map": "sheet", "Photo": "sheet"}}],
    "shown/id": [{"plugin": "get", "source": "No"}, {"plugin": "migration_lookup", "migration": "asset", "no_stub": True}],
    "shown/title": "Label",
    "of": [
        {"plugin": "get", "source": "No"},
        {"plugin": "migration_lookup", "migration": "object", "no_stub": True},
        {"plugin": "load_entity", "entity_type": "entity:object"},
    ],
}

ENTITY_SCHEMA = "entity_type string, bundle_key string, bundle string, value_key string, value string, id string"


def terms():
    """Entity rows for the kinds; codes differ in case from those of the mapping."""
    return [("term", "list", "kinds", "code", code.upper(), f"t{i}") for i, code in enumerate(KINDS.values())]
