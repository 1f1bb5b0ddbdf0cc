"""From records to matches in stages that are kept: what was written to its end is read again."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import addresses, names
from ..operators import decide
from ..session import new_path, resumed
from ..sources import sinks
from . import tables as T

STAGES = ("normalized", "candidates", "scored", "decided")


@dataclass(frozen=True)
class Config:
    """``label`` names the input's version; ``force`` rebuilds the stages from this one on; ``log`` is a folder for
    one row of counts a run."""

    label: str
    t_top1: float = 0.5
    t_extra: float = 0.8
    margin: float = 0.0
    exclusive: bool = True
    force: str | None = None
    log: str | None = None

    @classmethod
    def of_file(cls, spark: SparkSession, label: str, path: str) -> Config:
        """Thresholds from a file that ``sinks.write_json`` wrote; defaults for those that it lacks."""
        found = sinks.read_json(spark, path)
        return cls(label, **{k: v for k, v in found.items() if k in ("t_top1", "t_extra", "margin", "exclusive")})


def resolve(spark: SparkSession, raw: DataFrame, config: Config) -> DataFrame:
    """(s1_id, matched_ids) of records (entity_id, source, country, raw_name, raw_address)."""
    settings = {k: v for k, v in asdict(config).items() if k not in ("force", "log")}
    at = STAGES.index(config.force) if config.force else len(STAGES)

    def run(i: int, depends: list[str], build: Callable[[], DataFrame]) -> DataFrame:
        key = json.dumps([STAGES[i], {k: settings[k] for k in depends}], sort_keys=True)
        return resumed(spark, STAGES[i], key, build, force=i >= at)

    norm = run(0, ["label"], lambda: addresses.normalize_addresses(names.normalize_names(raw, scripts="latin", halves=False), scripts="latin").select(*T.NORMAL))
    cands = run(1, ["label"], lambda: T.uniting(norm))
    scored = run(2, ["label"], lambda: T.scoring(T.capping(cands), norm))
    s1 = T.s1_of(norm)
    out = run(3, list(settings), lambda: decide.decide(scored, s1, config.t_top1, config.t_extra, config.margin, config.exclusive))
    if config.log:
        counts = out.agg(F.count(F.lit(1)).alias("s1"), F.count(F.when(F.col("matched_ids") != "", 1)).alias("matched")).withColumn("settings", F.lit(json.dumps(settings, sort_keys=True)))
        sinks.append_log(counts, config.log)
    return out


def log_folder(spark: SparkSession) -> str:
    return new_path(spark, "log")
