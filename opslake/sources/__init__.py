from opslake.sources.readers import (
    NEVER_BLANK,
    all_text_csv,
    ensure_table,
    inline_rows,
    read_csv,
    read_json,
    read_table,
    read_known,
)
from opslake.sources.schemas import TABLES, TableSpec

__all__ = [
    "NEVER_BLANK", "TABLES", "TableSpec", "all_text_csv", "ensure_table", "inline_rows",
    "read_csv", "read_json", "read_known", "read_table",
]
