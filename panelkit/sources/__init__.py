"""Readers and writers."""

from .catalogue import first_datasets, pick_files, picked_paths, read_first_matches
from .delimited import (
    file_headers, possibly, read_drifting_csv, read_key_file, read_sheet, read_table,
    read_with_preamble, readable_paths,
)
from .faults import fault, list_files, sort_files
from .geojson import parse_features, polygon_columns, polygon_wkt, read_geojson, split_features
from .lines import file_lines, number_lines
from .sinks import write_panel_csv, write_polygons

__all__ = [
    "fault", "file_headers", "file_lines", "number_lines", "read_sheet", "split_features", "first_datasets", "list_files", "parse_features", "pick_files", "picked_paths", "polygon_columns",
    "polygon_wkt", "possibly", "read_drifting_csv", "read_first_matches", "read_geojson",
    "read_key_file",
    "sort_files", "read_table", "read_with_preamble", "readable_paths", "write_panel_csv", "write_polygons",
]
