"""Incremental curation: the curation steps applied to newly arriving raw files."""

from .incremental import append_to_layer, curate_stream, start_curation_stream, start_visit_cube_stream, stream_files

__all__ = ["append_to_layer", "curate_stream", "start_curation_stream", "start_visit_cube_stream", "stream_files"]
