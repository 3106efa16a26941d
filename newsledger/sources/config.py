"""Run configuration as data: the column schema with group switches, prompts,
paths and processing flags (a small JSON document read on the driver)."""

from __future__ import annotations

import copy
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REQUIRED_KEYS = ("llm_provider", "data_paths", "llm_settings", "columns", "prompts")
REQUIRED_PATHS = ("input_file", "base_file", "output_filled_file", "output_heat_data_file")
# Group name -> switch name.
GROUP_SWITCHES = (("location", "enable_all_location"), ("medical", "enable_all_medical"),
                  ("temperature", "enable_all_temperature"), ("datetime", "enable_all_datetime"),
                  ("basic_info", "enable_all_basic_info"))


class ConfigError(ValueError):
    pass


@dataclass
class RunConfig:
    raw: dict = field(default_factory=dict)

    @property
    def columns(self) -> list[dict]:
        return self.raw.get("columns", {}).get("schema", [])

    def enabled_columns(self) -> list[dict]:
        return [c for c in self.columns if c.get("enabled", False)]

    def column(self, name: str) -> dict | None:
        return next((c for c in self.columns if c["name"] == name), None)

    @property
    def mode(self) -> str:
        return self.raw.get("processing", {}).get("mode", "incremental")

    @property
    def skip_processed(self) -> bool:
        return bool(self.raw.get("processing", {}).get("skip_processed_records", True))

    @property
    def key(self) -> str:
        return self.raw.get("advanced", {}).get("base_database", {}).get("deduplication_key", "url")

    @property
    def base_enabled(self) -> bool:
        return bool(self.raw.get("advanced", {}).get("base_database", {}).get("enabled", True))

    def prompt(self, kind: str) -> dict:
        return self.raw.get("prompts", {}).get(kind, {})


def apply_group_switches(cfg: dict) -> dict:
    """A group switch overrides ``enabled`` of every column in its group."""
    cfg = copy.deepcopy(cfg)
    cols = cfg.get("columns", {})
    switches, groups = cols.get("bulk_operations", {}), cols.get("column_groups", {})
    for group, switch in GROUP_SWITCHES:
        if switch in switches:
            names = set(groups.get(group, []))
            for c in cols.get("schema", []):
                if c["name"] in names:
                    c["enabled"] = bool(switches[switch])
    return cfg


def validate_config(cfg: dict) -> None:
    missing = [k for k in REQUIRED_KEYS if k not in cfg]
    if missing:
        raise ConfigError(f"missing config keys: {missing}")
    if cfg["llm_provider"] not in cfg["llm_settings"]:
        raise ConfigError(f"provider {cfg['llm_provider']!r} not in llm_settings")
    missing = [k for k in REQUIRED_PATHS if k not in cfg["data_paths"]]
    if missing:
        raise ConfigError(f"missing data paths: {missing}")


def load_config(path: str) -> RunConfig:
    try:
        with open(path, encoding="utf-8") as f:
            cfg = json.load(f)
    except FileNotFoundError as e:
        raise ConfigError(f"config not found: {path}") from e
    except json.JSONDecodeError as e:
        raise ConfigError(f"invalid JSON in config: {e}") from e
    cfg = apply_group_switches(cfg)
    validate_config(cfg)
    return RunConfig(cfg)


def columns_frame(spark: SparkSession, cfg: dict) -> DataFrame:
    """Column metadata as a DataFrame with the group switches applied by a
    join (``coalesce(switch, enabled)``)."""
    cols = cfg.get("columns", {})
    rows = [(c["name"], bool(c.get("enabled", False)), c.get("data_type", "text"),
             c.get("extraction_hint", ""), str(c.get("example", ""))) for c in cols.get("schema", [])]
    meta = spark.createDataFrame(rows, "name string, enabled boolean, data_type string, hint string, example string")
    switches = cols.get("bulk_operations", {})
    grp = [(n, g, bool(switches[s])) for g, s in GROUP_SWITCHES if s in switches
           for n in cols.get("column_groups", {}).get(g, [])]
    groups = spark.createDataFrame(grp, "name string, grp string, group_enabled boolean")
    out = meta.join(groups, "name", "left")
    return out.select("name", F.coalesce("group_enabled", "enabled").alias("enabled"), "data_type", "hint", "example")
