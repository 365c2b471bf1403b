"""Datasets of a pipeline and the names and paths derived from them."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from .session import join_path


def slug(name: str) -> str:
    """Lower-cased name, every character outside [0-9a-z_] replaced by ``_``."""
    return re.sub(r"[^0-9a-z_]", "_", name.lower())


@dataclass(frozen=True)
class Dataset:
    """One configured feed. ``multi_line`` says that its landing files hold
    JSON arrays and not one record per line; ``extra_fields`` are landing fields
    that bronze keeps, as text, besides the usual ones."""

    id: int
    name: str
    multi_line: bool = False
    extra_fields: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.id}_{slug(self.name)}"

    @property
    def bronze_table(self) -> str:
        return f"{self.key}_raw_table"

    @property
    def silver_table(self) -> str:
        return self.key


def parse_datasets(text: str) -> list[Dataset]:
    """Datasets from a JSON array of ``{"id": .., "name": ..}`` objects."""
    try:
        return [
            Dataset(
                int(item["id"]),
                item["name"],
                bool(item.get("multi_line", False)),
                tuple(item.get("extra_fields", ())),
            )
            for item in json.loads(text)
        ]
    except (TypeError, ValueError, KeyError, AttributeError) as error:
        raise ValueError(f"not a dataset list: {text!r}") from error


@dataclass(frozen=True)
class Layout:
    """Where the layers of one environment lie."""

    root: str
    environment: str = "dev"
    prefix: str = "gridtide"  # of the names under which SQL finds the layers

    def at(self, *parts: str) -> str:
        return join_path(self.root, self.environment, *parts)

    @property
    def landing(self) -> str:
        return self.at("landing")

    def landing_of(self, dataset: Dataset) -> str:
        return self.at("landing", f"dataset={dataset.key}")

    def bronze(self, dataset: Dataset) -> str:
        return self.at("bronze", dataset.bronze_table)

    def silver(self, dataset: Dataset) -> str:
        return self.at("silver", dataset.silver_table)

    def gold(self, table: str) -> str:
        return self.at("gold", table)

    def checkpoint(self, layer: str, table: str) -> str:
        return self.at("_checkpoints", layer, table)

    @property
    def control(self) -> str:
        return self.at("landing_admin", "meta_control_table")
