"""Dropping trajectories from the model tables and cleaning what no trajectory uses."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajspark import settings
from trajspark.operators.ids import Model


def drop_pgtraj(model: Model, name: str) -> Model:
    """Remove a pgtraj with its bursts and step relations; its steps and relocations stay as orphans."""
    pgtraj = model.pgtraj.filter(F.col("pgtraj_name") != name)
    bursts = model.animal_burst.join(pgtraj.select(F.col("id").alias("pgtraj_id")), "pgtraj_id", "left_semi")
    kept = bursts.select(F.col("id").alias("animal_burst_id"))
    relations = settings.join_small(model.s_b_rel, kept, "animal_burst_id", "left_semi")
    return replace(model, pgtraj=pgtraj, animal_burst=bursts, s_b_rel=relations)


def unused_relocations(model: Model) -> DataFrame:
    """Relocations at neither end of a step of any pgtraj."""
    steps = model.step.join(model.s_b_rel.select(F.col("step_id").alias("id")), "id", "left_semi")
    ends = steps.select(F.explode(F.array("relocation_id_1", "relocation_id_2")).alias("id")).filter("id IS NOT NULL")
    return model.relocation.join(ends, "id", "left_anti")


def full_clean(model: Model) -> Model:
    """Remove unused relocations. Steps that began at one go too; ends that pointed at one become null."""
    gone = settings.write_through(unused_relocations(model).select("id"), "unused")
    gone = settings.broadcast_if(gone, gone.count())
    begins = gone.withColumnRenamed("id", "relocation_id_1")
    ends = gone.select(F.col("id").alias("relocation_id_2"), F.lit(True).alias("_gone"))
    steps = model.step.join(begins, "relocation_id_1", "left_anti").join(ends, "relocation_id_2", "left")
    steps = steps.withColumn("relocation_id_2", F.when(F.col("_gone").isNull(), F.col("relocation_id_2"))).drop("_gone")
    return replace(
        model,
        relocation=model.relocation.join(gone, "id", "left_anti"),
        step=steps.select(*model.step.columns),
        s_b_rel=model.s_b_rel.join(steps.select(F.col("id").alias("step_id")), "step_id", "left_semi"),
    )


def overwritten(stored: DataFrame, incoming: DataFrame, overwrite: bool = False) -> DataFrame:
    """Stored rows with the pgtrajs of ``incoming`` replaced. Without ``overwrite`` an existing name is an error."""
    names = incoming.select("pgtraj_name").distinct()
    if not overwrite:
        taken = stored.join(names, "pgtraj_name", "left_semi").select("pgtraj_name").limit(1).collect()
        if taken:
            raise ValueError(f"the pgtraj {taken[0][0]!r} already exists")
    return stored.join(names, "pgtraj_name", "left_anti").unionByName(incoming)
