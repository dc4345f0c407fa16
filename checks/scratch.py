"""Scratch space of the registered queries; see ``stratalake.sources.scratch``."""

from stratalake.sources.scratch import scratch_folder

__all__ = ["scratch_folder"]
