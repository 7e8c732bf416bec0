"""Incremental maintenance of the cube with Structured Streaming."""

from demandgrid.streaming.runner import SupervisedPolling, day_stream, fold_unprocessed_days, poll, run_once, start
from demandgrid.streaming.store import CubeStore

__all__ = ["CubeStore", "SupervisedPolling", "day_stream", "fold_unprocessed_days", "poll", "run_once", "start"]
