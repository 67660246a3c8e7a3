"""Sequential ids and the normalised model tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajspark import settings
from trajspark.operators.steps import BURST, TYPE_II, build_steps
from trajspark.plans.segments import Known, Laid, RowNumber, RunningSum, lay_out, with_prefix
from trajspark.settings import write_through
from trajspark.sources.tables import pgtraj_rows


def burst_sizes(laid: Laid, inside: tuple[str, ...] = (), sizes: DataFrame | None = None) -> DataFrame:
    """Per burst: its rank, the steps in it and the steps in earlier bursts (of the pgtraj, when ``inside``).

    Rows are counted per burst with map-side combine, unless ``sizes`` has the names and ``burst_steps`` already; the running sum goes over
    that small table.
    """
    names = sizes
    if sizes is None:
        sizes = laid.df.groupBy(*BURST).agg(F.count(F.lit(1)).alias("burst_steps"))
        names = laid.df.select(*BURST).distinct()
    order = tuple(k for k in BURST if k not in inside)
    known = laid.n_groups if laid.keys == BURST else None
    chain = lay_out(sizes, inside, order, count_on=names, known_rows=known)
    chain = with_prefix(chain, burst_id=RowNumber(), _upto=RunningSum(F.col("burst_steps")))
    return chain.rows().withColumn("_earlier", F.col("_upto") - F.col("burst_steps")).drop("_upto")


def with_step_ids(laid: Laid, sizes: DataFrame | None = None) -> Laid:
    """Global ids in (pgtraj, burst, order) order: steps of earlier bursts plus the position in the burst.

    Needs ``seq``; gives relocation_id_2 when ``seq2`` is there. The steps themselves are never sorted globally.
    """
    return _numbered(laid.join_groups(burst_sizes(laid, sizes=sizes), laid.n_groups))


def _numbered(laid: Laid) -> Laid:
    """Step and relocation ids from ``_earlier`` and the positions in the burst."""
    df = laid.df.withColumn("step_id", F.col("_earlier") + F.col("seq"))
    df = df.withColumn("relocation_id_1", F.col("step_id"))
    if "seq2" in df.columns:
        df = df.withColumn("relocation_id_2", F.col("_earlier") + F.col("seq2"))
    return laid.on(df.drop("_earlier", "burst_steps"))


#: Columns that tell the bursts of ``placed`` rows apart. The rows of a range are together already, and in the order of their ids.
PLACED = ("pgtraj_name", "_range", "burst_id")


def placed(rows: DataFrame, bursts: DataFrame, known: Known, total: int, rows_a_range: int) -> tuple[DataFrame, tuple[str, ...]]:
    """Rows with their burst's id, clustered by ranges of the ids that their steps will have, a burst in one range; and the keys of ordered work.

    ``bursts`` has pgtraj_name, burst_name, burst_id and _earlier for each burst, ``total`` is the number of rows. Ordered work by ``PLACED`` and a write in id order need no other
    shuffle. Where a burst is larger than a task should hold, rows are left as they are, to be split by burst.
    """
    if known.largest > settings.hot_rows(rows.sparkSession):
        return rows, BURST
    table = bursts.select(*BURST, "burst_id", "_earlier")
    found = rows.join(settings.broadcast_if(table, known.groups), ["burst_name", "pgtraj_name"], "left")
    n = -(-total // rows_a_range)
    return found.withColumn("_range", F.floor(F.col("_earlier") / rows_a_range)).repartition(max(1, n), "_range"), PLACED


def with_burst_ids(laid: Laid, bursts: DataFrame) -> Laid:
    """``with_step_ids`` where the bursts are numbered; rows that are ``placed`` carry their numbers already."""
    if laid.keys != PLACED:
        laid = laid.join_groups(bursts.select(*BURST, "burst_id", "_earlier"), laid.n_groups)
    numbered = _numbered(laid)
    return numbered.on(numbered.df.drop("_range"))


@dataclass(frozen=True)
class Model:
    """The five normalised tables."""

    pgtraj: DataFrame
    animal_burst: DataFrame
    relocation: DataFrame
    step: DataFrame
    s_b_rel: DataFrame


def model_tables(relocations: DataFrame, kind: int = TYPE_II) -> Model:
    """All model tables of bound relocations: projections of the numbered steps, the bursts and pgtrajs, each written once."""
    groups = lay_out(pgtraj_rows(relocations), (), ("pgtraj_name",))
    pgtraj = write_through(with_prefix(groups, id=RowNumber()).rows(), "pgtraj")
    rows = write_through(with_step_ids(build_steps(relocations, kind, numbered=True)).rows(), "steps")
    bursts = rows.groupBy(*BURST).agg(F.min("burst_id").alias("id"), F.min("animal_name").alias("animal_name"))
    bursts = write_through(bursts.join(pgtraj.select("pgtraj_name", F.col("id").alias("pgtraj_id")), "pgtraj_name"), "bursts")
    return Model(
        pgtraj=pgtraj.select("id", "pgtraj_name", "proj4string", "time_zone", "note"),
        animal_burst=bursts.select("id", "burst_name", "animal_name", "pgtraj_id"),
        relocation=rows.select(F.col("relocation_id_1").alias("id"), "x", "y", "srid", "us", F.col("rid").alias("orig_id")),
        step=rows.select(F.col("step_id").alias("id"), "relocation_id_1", "relocation_id_2", "dt_us"),
        s_b_rel=rows.select("step_id", F.col("burst_id").alias("animal_burst_id")),
    )
