"""Experiment cohorts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ids up to this one form the control group.
CONTROL_USERS = 10_000


def cohort(user_id: Column, control_users: int = CONTROL_USERS) -> Column:
    """``control`` for ids up to ``control_users``, ``test`` above; NULL without an id."""
    return F.when(user_id <= control_users, "control").when(user_id > control_users, "test")
