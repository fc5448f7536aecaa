"""Structured Streaming forms of the landing scan and the grid mean."""

from voltframe.streaming.grid import emissions_landing_stream, slot_means_stream, start_slot_sink  # noqa: F401
