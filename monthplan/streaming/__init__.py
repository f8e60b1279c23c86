"""Continuous trigger for the batch pipeline (the reference itself has no streaming operators)."""

from monthplan.streaming.batches import plan_landed_batches  # noqa: F401
