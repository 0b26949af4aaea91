from landledger.sources.archives import read_zip_members, scan_zip_csv
from landledger.sources.audit import audit_contents, audit_files
from landledger.sources.files import (
    asked_only,
    local_file,
    object_path,
    scan_csv,
    scan_jdbc,
    scan_json_document,
    scan_jsonl,
    scan_table,
    text_schema,
)
from landledger.sources.ranges import block_checksums, byte_ranges, list_files, list_members, read_blocks, read_members

__all__ = [
    "asked_only",
    "audit_contents",
    "audit_files",
    "block_checksums",
    "byte_ranges",
    "list_files",
    "list_members",
    "local_file",
    "object_path",
    "read_blocks",
    "read_members",
    "read_zip_members",
    "scan_csv",
    "scan_jdbc",
    "scan_json_document",
    "scan_jsonl",
    "scan_table",
    "scan_zip_csv",
    "text_schema",
]
