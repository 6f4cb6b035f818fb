"""Job parameters: one frozen value per run, no mutable configuration."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace
from datetime import date
from itertools import product
from typing import Any

from earshot.functions.dates import dated_input_name, yesterday_text


@dataclass(frozen=True)
class AlsParams:
    """Explicit-feedback, non-negative factorisation.

    ``seed`` must be set: PySpark's own default differs between processes.
    """

    rank: int = 10
    max_iter: int = 10
    reg: float = 0.01
    nonnegative: bool = True
    seed: int = 12
    # MLlib's default of ten blocks means ten tasks; larger inputs get one block
    # per this many ratings (see operators.als.block_count).
    ratings_per_block: int = 4_000_000
    user_blocks: int | None = None
    item_blocks: int | None = None
    pin_layout: bool = True


# The property names job files use today, and the field each sets; the
# folders and tables below, where they lie.
PROPERTY_FIELDS = {
    "appName": "app_name",
    "hdfsUrl": "storage_root",
    "hdfsDir": "model_dir",
    "hdfsRatingsSourceDir": "ratings_dir",
    "hdfsRatingsFileName": "ratings_name",
    "hdfsListenDir": "listen_dir",
    "hdfsListenFileName": "listen_name",
    "hdfsSingDir": "sing_dir",
    "hdfsSingFileName": "sing_name",
    "hbaseRecommendTableName": "recommend_table",
    "recommendCount": "k",
    "hbaseListenTableName": "listen_table",
    "hbaseSingTableName": "sing_table",
}
# Deployment settings that spark-submit owns here; accepted and left alone.
DEPLOYMENT_PROPERTIES = frozenset(
    {
        "sparkMaster",
        "sparkOtherConfig_numThreads",
        "hbaseZookeeperPort",
        "hbaseZookeeperQuorum",
        "hbaseMaster",
    }
)


@dataclass(frozen=True)
class JobParams:
    """Everything a job needs.  A blank input name means yesterday's file."""

    storage_root: str
    run_date: date
    app_name: str = "earshot"
    model_dir: str = "model/"
    ratings_dir: str = "rcmd/rating/song/"
    ratings_name: str = ""
    listen_dir: str = "rcmd/listen/"
    listen_name: str = ""
    sing_dir: str = "rcmd/sing/"
    sing_name: str = ""
    recommend_table: str = "recommend_als"
    listen_table: str = "recommend_listen"
    sing_table: str = "recommend_sing"
    k: int = 5
    weights: tuple[float, float, float] = (0.6, 0.2, 0.2)
    on_bad_line: str = "quarantine"
    als: AlsParams = field(default_factory=AlsParams)
    # Settings to choose from by their validation error; none means those of ``als``.
    grid: tuple[AlsParams, ...] = ()
    # Whether recommendations leave out what a user has rated.
    exclude_rated: bool = False

    def __post_init__(self) -> None:
        if not self.storage_root.strip():
            raise ValueError("storage_root must be set")
        if self.k < 1:
            raise ValueError(f"k must be at least 1, got {self.k}")
        if self.on_bad_line not in ("quarantine", "fail"):
            raise ValueError(f"on_bad_line: 'quarantine' or 'fail', not {self.on_bad_line!r}")
        tables = (self.recommend_table, self.listen_table, self.sing_table)
        if len(set(tables)) != len(tables):
            raise ValueError(f"each job needs its own target table, got {tables}")

    @classmethod
    def from_properties(
        cls, properties: Mapping[str, str], run_date: date, **overrides: Any
    ) -> JobParams:
        """Parameters from property names; an unknown name or bad value raises."""
        known = {f.name for f in fields(cls)}
        values: dict[str, Any] = {}
        als: dict[str, Any] = {}
        choices: dict[str, list[Any]] = {}
        for name, text in properties.items():
            if name in DEPLOYMENT_PROPERTIES:
                continue
            target = PROPERTY_FIELDS.get(name, name)
            group, dot, setting = target.partition(".")
            if group == "als" and dot and setting in ALS_READERS:
                als[setting] = ALS_READERS[setting](text)
            elif group == "grid" and dot and setting in ALS_READERS:
                choices[setting] = [ALS_READERS[setting](one) for one in text.split(",")]
            elif target not in known or target in ("run_date", "als", "grid"):
                raise ValueError(f"unknown job property {name!r}")
            else:
                values[target] = READERS.get(target, str)(text)
        values["als"] = AlsParams(**als)
        if choices:
            values["grid"] = tuple(
                AlsParams(**als | dict(zip(choices, chosen, strict=True)))
                for chosen in product(*choices.values())
            )
        values.update(overrides)
        return cls(run_date=run_date, **values)

    def with_(self, **changes: Any) -> JobParams:
        return replace(self, **changes)

    # -- places -----------------------------------------------------------

    def _under_root(self, *parts: str) -> str:
        return "/".join([self.storage_root.rstrip("/"), *(p.strip("/") for p in parts)])

    @property
    def yesterday(self) -> str:
        return yesterday_text(self.run_date)

    def input_name(self, name: str) -> str:
        return dated_input_name(name, self.run_date)

    @property
    def ratings_path(self) -> str:
        return self._under_root(self.ratings_dir, self.input_name(self.ratings_name))

    @property
    def listen_path(self) -> str:
        return self._under_root(self.listen_dir, self.input_name(self.listen_name))

    @property
    def sing_path(self) -> str:
        return self._under_root(self.sing_dir, self.input_name(self.sing_name))

    @property
    def model_path(self) -> str:
        return self._under_root(self.model_dir, self.yesterday)

    def table_path(self, table: str) -> str:
        return self._under_root("tables", table)

    def cells_path(self, table: str) -> str:
        """The table of cells that days are merged into."""
        return self._under_root("cells", table)

    def ledger_path(self, table: str) -> str:
        return self._under_root("ledger", table)

    def days_path(self, record_name: str) -> str:
        """Parsed rows of the days that were merged, a folder each."""
        return self._under_root("parsed_days", record_name)

    def dated_folder(self, record_name: str) -> str:
        """Where the dated folders of a record's text are."""
        folders = {"rating": self.ratings_dir, "listen": self.listen_dir, "sing": self.sing_dir}
        return self._under_root(folders[record_name])

    def parsed_path(self, record_name: str) -> str:
        """Parsed rows lie under the name of their input, so that days stay apart."""
        name = {
            "rating": self.ratings_name,
            "listen": self.listen_name,
            "sing": self.sing_name,
        }[record_name]
        return self._under_root("parsed", record_name, self.input_name(name))

    @property
    def checkpoint_path(self) -> str:
        return self._under_root("checkpoints")


def _flag(text: str) -> bool:
    if text.lower() not in ("true", "false"):
        raise ValueError(f"true or false, not {text!r}")
    return text.lower() == "true"


def _weights(text: str) -> tuple[float, float, float]:
    first, second, third = (float(part) for part in text.split(","))
    return first, second, third


# How the settings that are not text are read; ``als.`` stands before those of the fit, ``grid.``
# before lists of them to choose from.
READERS = {"k": int, "weights": _weights, "exclude_rated": _flag}
ALS_READERS = {
    "rank": int,
    "max_iter": int,
    "reg": float,
    "nonnegative": _flag,
    "seed": int,
    "ratings_per_block": int,
    "user_blocks": int,
    "item_blocks": int,
    "pin_layout": _flag,
}

_ESCAPED = re.compile(r"\\(u[0-9a-fA-F]{4}|.)", re.S)
_SEPARATOR = re.compile(r"(?:[^\\=: \t\f]|\\.)*")


def read_properties(text: str) -> dict[str, str]:
    """Java property text: ``=``, ``:`` or a space after the name, backslash escapes.

    Blank lines and ``#`` / ``!`` comments are skipped; an odd number of backslashes at the
    end of a line joins it to the next.  A name without a separator raises, since that is
    a mistake in a job file.
    """
    found: dict[str, str] = {}
    held = ""
    for raw in text.splitlines():
        line = held + raw.lstrip(" \t\f")
        held = ""
        if not line or line[0] in "#!":
            continue
        if (len(line) - len(line.rstrip("\\"))) % 2:
            held = line[:-1]
            continue
        name = _SEPARATOR.match(line)[0]
        rest = line[len(name) :].lstrip(" \t\f")
        if not rest and len(name) == len(line):
            raise ValueError(f"not a name=value line: {line!r}")
        if rest[:1] in ("=", ":"):
            rest = rest[1:].lstrip(" \t\f")
        found[_unescape(name)] = _unescape(rest).strip()
    return found


def _unescape(text: str) -> str:
    plain = {"t": "\t", "n": "\n", "r": "\r", "f": "\f"}
    return _ESCAPED.sub(
        lambda m: chr(int(m[1][1:], 16)) if len(m[1]) > 1 else plain.get(m[1], m[1]), text
    )
