"""Scratch tables that a run leaves."""

import os

from sheetrecon.session import ensure_checkpoint_dir


def tables(spark):
    return set(os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")))


def left_by(spark, run):
    """Names of the scratch tables that are there when the result of ``run`` was read."""
    before = tables(spark)
    run().collect()
    return sorted(x.rsplit("-", 1)[0] for x in tables(spark) - before)
