"""Names and values shared across the package."""

# Tags and name formats that existing catalogs rely on.
TEMPLATE_TAG = "isi_template"
DERIVED_TAG = "isi_derived_migration"
DERIVED_MARK = "isimd"
ORPHANS_TAG = "isi_manage_orphans"
GROUP_NAME_FORMAT = "isi__{request}"
MIGRATION_NAME_FORMAT = "{group}_{migration}"
REQUEST_TAG_FORMAT = "isimd:{request}"
ACCEPTED_FORMATS = ("xlsx", "ods", "csv")

# Source defaults of a derived group.
SOURCE_DEFAULTS = {
    "track_changes": True,
    "header_row": 1,
    "keys": {"ID": "integer"},
}

# The characters a default trim removes.
TRIM_CHARS = " \t\n\r\0\x0b"

# Id-map states.
IMPORTED = "imported"
IGNORED = "ignored"
FAILED = "failed"
NEEDS_UPDATE = "needs_update"

# Id-map rollback actions.
ROLLBACK_DELETE = "delete"
ROLLBACK_PRESERVE = "preserve"

# Joins the parts of a composite key into one text.
KEY_SEPARATOR = "\x1f"

# Stands for NULL inside a row hash, so that NULL and '' differ.
NULL_MARK = "\x00"
