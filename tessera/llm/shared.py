"""The folder that driver and executors share."""

from tessera.sources.shared import cut, ready, spread_out

__all__ = ["cut", "ready", "spread_out"]
