"""What to load, from where, how: plain values that the plans take, and the presets."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace
from datetime import date
from typing import Any

# Texts that mean "yes" in an option.
YES = ("true", "1", "yes")


@dataclass(frozen=True)
class CsvLoad:
    table: str
    pattern: str | None = None
    glob: str | None = None
    base: str | None = None
    columns: tuple[str, ...] | None = None
    start_date: str | date | None = "2025-01-01"
    load_mode: str = "historical"
    latest_of: str = "new"
    max_files: int | None = None
    max_columns: int | None = None
    fingerprint: str = "content"
    max_content_bytes: int | None = None
    sep: str = ","
    encoding: str = "UTF-8"
    cluster: bool = False
    batch_files: int = 4096  # files landed by one append
    recheck: bool = False  # open files the ledger knows as well
    settle_seconds: float = 2.0
    dry_run: bool = False


@dataclass(frozen=True)
class DocumentLoad:
    collection: str
    table: str
    query: Mapping[str, Any] | None = None
    fields: tuple[str, ...] | None = None
    mode: str = "append"  # append, append_new, upsert
    limit: int | None = None
    order_by: str | None = None
    batch_size: int = 25000  # only figures in dry runs
    cluster: bool = False
    dry_run: bool = False


@dataclass(frozen=True)
class PatchLoad:
    view: str
    collection: str
    match_field: str
    target_match_field: str
    field_mapping: Mapping[str, str] = field(default_factory=dict)
    where: str | None = None
    order_by: str | None = None
    batch_size: int = 5000  # only figures in dry runs
    dry_run: bool = False


# The pipelines that come predefined.
CSV_PRESETS = {
    "DATA_SOURCE_1": CsvLoad(table="raw_source_1", pattern=r".*/data_source_file_01.*\.csv"),
    "DATA_SOURCE_2": CsvLoad(table="raw_source_2", pattern=r".*/data_source_file_02.*\.csv"),
}
DOCUMENT_PRESETS = {
    "TRANSACTIONS": DocumentLoad(
        collection="transactions",
        table="transactions",
        query={"valueDate": {"$gte": 1735689600000}},
        fields=(
            "_id",
            "transactionId",
            "transactionDate",
            "netAmount",
            "date",
            "store",
            "transactionAmount",
            "currency",
        ),
        mode="upsert",
    ),
    "STORES": DocumentLoad(
        collection="stores",
        table="stores",
        fields=("_id", "address", "merchantId", "storeId", "storeName"),
        mode="upsert",
    ),
    "MERCHANTS": DocumentLoad(
        collection="merchants",
        table="merchants",
        fields=("_id", "brand", "isActive", "type", "merchantId"),
        mode="upsert",
    ),
}
PATCH_PRESETS = {
    "transactions": PatchLoad(
        view="TRANSACTIONS_VW",
        collection="transactions",
        match_field="TRANSACTION_ID",
        target_match_field="transactionId",
        field_mapping={"AMOUNT": "Amount"},
    ),
}


def preset(name: str) -> CsvLoad | DocumentLoad | PatchLoad:
    for presets in (CSV_PRESETS, DOCUMENT_PRESETS, PATCH_PRESETS):
        if name in presets:
            return presets[name]
    raise ValueError(f"unknown preset: {name}")


def preset_names() -> list[str]:
    return [*CSV_PRESETS, *DOCUMENT_PRESETS, *PATCH_PRESETS]


def as_flag(value: Any, default: bool = False) -> bool:
    if value is None:
        return default
    return value.lower() in YES if isinstance(value, str) else bool(value)


def as_count(value: Any, default: int | None = None) -> int | None:
    return default if value is None or value == "" else int(value)


FLAGS = {"dry_run", "cluster", "recheck"}
COUNTS = {"max_files", "max_columns", "max_content_bytes", "batch_files", "limit", "batch_size"}


def with_options(spec: Any, *layers: Mapping[str, Any] | None) -> Any:
    """Spec with run-time options laid over it; later layers win, texts become flags and numbers.

    Options a spec does not have are passed over, as job parameters are shared between kinds of jobs.
    ``upsert`` is taken as a way to spell the mode of a document load.
    """
    options: dict[str, Any] = {}
    for layer in layers:
        options.update(layer or {})
    known = {f.name: f for f in fields(spec)}
    changes: dict[str, Any] = {}
    for name, value in options.items():
        if name == "upsert" and "mode" in known:
            changes["mode"] = "upsert" if as_flag(value, True) else "append"
        elif name in known:
            if name in FLAGS:
                value = as_flag(value)
            elif name in COUNTS:
                value = as_count(value, getattr(type(spec), name, None))
            changes[name] = value
    return replace(spec, **changes)


def parse_field_mapping(text: str) -> dict[str, str]:
    """``A:b,C`` as ``{"A": "b", "C": "c"}``: source names upper case, a bare name lower case in the target."""
    mapping = {}
    for pair in text.split(","):
        source, colon, target = pair.strip().partition(":")
        mapping[source.strip().upper()] = target.strip() if colon else source.strip().lower()
    return mapping
