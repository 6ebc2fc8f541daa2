"""Declarative table list: what to extract, from where, keyed and dated how."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from datetime import date
from typing import Any

IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_$]*(\.[A-Za-z_][A-Za-z0-9_$]*)*")
FOLDER = re.compile(r"\w[\w.-]*")

# The names a table entry uses in the YAML file, and the field each one sets.
TABLE_KEYS = {
    "table_name": "table",
    "numPartitions": "num_partitions",
    "lowerBound": "lower_bound",
    "upperBound": "upper_bound",
    "partitionColumn": "partition_column",
    "primaryKey_col": "primary_key",
    "lastUpdate_col": "last_update_column",
    "columns": "columns",
    "bucketColumn": "bucket_column",
    "buckets": "buckets",
    "initial": "initial",
    "bounds": "bounds",
    "rowsPerPartition": "rows_per_partition",
    "rowsPerFile": "rows_per_file",
}
# Of these, source_name and source_type say nothing here; lists that have them are still read.
DATABASE_KEYS = {"db_name", "job", "source_name", "source_type", "tbl_list"}


def check_identifier(name: str) -> str:
    """Names are the only free text that reaches SQL, so they have to look like names."""
    if not IDENTIFIER.fullmatch(name):
        raise ValueError(f"not a plain SQL name: {name!r}")
    return name


@dataclass(frozen=True)
class TableSpec:
    table: str
    num_partitions: int | None = None
    lower_bound: int | str | date | None = None
    upper_bound: int | str | date | None = None
    partition_column: str | None = None
    primary_key: tuple[str, ...] = ()
    last_update_column: str | None = None
    columns: tuple[str, ...] = ()
    bucket_column: str | None = None
    buckets: int = 2
    initial: str = "all"
    bounds: str = "minmax"
    rows_per_partition: int = 10_000
    rows_per_file: int = 1_000_000
    source: str = "default"
    database: str = "default"
    job: str = "get_data"

    def __post_init__(self) -> None:
        for name in ("primary_key", "columns"):
            value = getattr(self, name)
            if value is None:
                value = ()
            elif isinstance(value, str):
                value = (value,)
            object.__setattr__(self, name, tuple(value))
        for name in ("num_partitions", "buckets", "rows_per_partition", "rows_per_file"):
            if getattr(self, name) is not None:
                object.__setattr__(self, name, int(getattr(self, name)))
        names = [self.table, self.job, *self.primary_key, *self.columns]
        names += [n for n in (self.partition_column, self.last_update_column, self.bucket_column) if n]
        for name in names:
            check_identifier(name)
        for name in (self.source, self.database):
            if not FOLDER.fullmatch(name):
                raise ValueError(f"not usable as a folder name: {name!r}")
        if self.columns and self.split_key and self.split_key not in self.columns:
            raise ValueError(f"{self.table}: the reading is split by {self.split_key}, so columns must hold it")
        if self.initial not in ("all", "since_start"):
            raise ValueError(f"initial must be 'all' or 'since_start', not {self.initial!r}")
        if self.bounds not in ("minmax", "count", "rows"):
            raise ValueError(f"bounds must be 'minmax', 'count' or 'rows', not {self.bounds!r}")
        if self.bounds == "rows" and not all(b is None or str(b).lower() in ("min", "max") for b in (self.lower_bound, self.upper_bound)):
            raise ValueError(f"{self.table}: strides of equally many rows have no fixed ends")
        for name in ("buckets", "rows_per_partition", "rows_per_file"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")

    @property
    def bucket_key(self) -> str | None:
        """The column hashed for a table without a split column: named, or else the first key."""
        if self.bucket_column:
            return self.bucket_column
        return self.primary_key[0] if self.primary_key else None

    @property
    def split_key(self) -> str | None:
        """The column a parallel read goes by, if there is one."""
        if self.partition_column:
            return self.partition_column
        return None if self.last_update_column and not self.num_partitions else self.bucket_key

    @property
    def stride_column(self) -> str | None:
        """The column strides go by: the split column, else the date column."""
        return self.partition_column or self.last_update_column


@dataclass(frozen=True)
class Connection:
    """Where a source lives. The password stays in the environment until a read asks for it."""

    user: str
    url: str
    password_env: str | None = None
    driver: str | None = None
    fetch_size: int = 100_000
    extra: Mapping[str, str] = field(default_factory=dict)

    def password(self) -> str | None:
        if self.password_env is None:
            return None
        if self.password_env not in os.environ:
            raise KeyError(f"environment variable {self.password_env} is not set")
        return os.environ[self.password_env]


def table_spec(entry: Mapping[str, Any], **context: Any) -> TableSpec:
    """One YAML entry, bound by name; keys in any order, unknown keys refused."""
    unknown = set(entry) - set(TABLE_KEYS)
    if unknown:
        raise ValueError(f"unknown keys in table entry: {sorted(unknown)}")
    if not entry.get("table_name"):
        raise ValueError("table entry without table_name")
    defaults = {f.name: f.default for f in fields(TableSpec)}
    values = {}
    for key, value in entry.items():
        name = TABLE_KEYS[key]
        values[name] = defaults[name] if value is None else value
    return TableSpec(**values, **context)


def parse_specs(config: Mapping[str, Any]) -> list[TableSpec]:
    """Sources -> databases -> tables, flattened; an absent or empty table list gives no tables."""
    specs = []
    for source in config.get("config") or []:
        for database in source.get("databases") or []:
            unknown = set(database) - DATABASE_KEYS
            if unknown:
                raise ValueError(f"unknown keys in database entry: {sorted(unknown)}")
            for entry in database.get("tbl_list") or []:
                specs.append(
                    table_spec(
                        entry,
                        source=source["user"],
                        database=database["db_name"],
                        job=database.get("job") or "get_data",
                    )
                )
    return specs


def parse_connections(env: Mapping[str, Any]) -> dict[str, Connection]:
    """Connections by source name. ``password: ${NAME}`` names a variable; plain text is refused."""
    connections = {}
    for entry in env.get("db") or []:
        password = entry.get("password")
        reference = re.fullmatch(r"\$\{(\w+)\}", password) if password else None
        if password and not reference:
            raise ValueError(f"password of {entry['user']}: write ${{NAME}}, not the password itself")
        if entry["user"] in connections:
            raise ValueError(f"two connections are named {entry['user']!r}")
        connections[entry["user"]] = Connection(
            user=entry["user"],
            url=entry["url"],
            password_env=reference.group(1) if reference else None,
            driver=entry.get("driver"),
            fetch_size=int(entry.get("fetchsize") or Connection.fetch_size),
            extra={str(k): str(v) for k, v in (entry.get("options") or {}).items()},
        )
    return connections


def read_yaml(text: str) -> Mapping[str, Any]:
    import yaml

    return yaml.safe_load(text) or {}


def load_specs(path: str) -> list[TableSpec]:
    with open(path, encoding="utf-8") as f:
        return parse_specs(read_yaml(f.read()))


def load_connections(path: str) -> tuple[dict[str, Connection], str]:
    """The connections and the output root of an environment file."""
    with open(path, encoding="utf-8") as f:
        env = read_yaml(f.read())
    root = env.get("hdfs") or env.get("root")
    if not root:
        raise ValueError(f"{path} names no output root (hdfs or root)")
    return parse_connections(env), root
