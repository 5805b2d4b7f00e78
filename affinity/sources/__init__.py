"""Scans: explicit-schema CSV readers for the logical tables and the adapter
that derives the same logical tables from the provided parquet fixtures."""

from .csv import (get_schemas, good_rows, load_datasets, read_checked, read_interactions, read_items,
                  read_tags, reject_report, rejected_rows)
from .fixtures import (brand_interactions, doc_arrays, doc_members, documents_table, interaction_lines, interactions,
                       items, items_with_variants, order_baskets, raw_interactions, tags)

__all__ = [
    "get_schemas", "load_datasets", "read_interactions", "read_items", "read_tags",
    "interactions", "raw_interactions", "items", "items_with_variants", "tags",
    "brand_interactions", "doc_arrays", "doc_members", "documents_table", "interaction_lines", "order_baskets",
    "read_checked", "good_rows", "rejected_rows", "reject_report",
]
