"""DataFrame-level steps."""

from .aggregate import Measure, complete_sum, group_constant, lenient_sum, measure_rows
from .aggregate import measure_present, summarise, summarise_through
from .bind import bind_rows, distinct_rows, harmonise
from .columns import (
    add_in_stages, apply_to, col_range, drop_suffix, replace_missing, transmute,
)
from .complete import complete
from .deflate import deflate, price_index
from .joins import heavy_keys, left_join, require_unique
from .recode import lookup_table, recode, recode_names
from .retype import guess_types, retype
from .rows import arrange, drop_first_rows, first_rows
from .shares import add_share, add_stack
from .spatial import (
    count_in_polygons, covered_by, keep_inside, match_points, point_columns, point_problems,
    spatial_left_join, tile_polygons,
)
from .staging import drop_scratch, fits_in_broadcast, scratch_path, settle

__all__ = [
    "Measure", "add_in_stages", "add_share", "add_stack", "apply_to", "arrange", "bind_rows",
    "col_range", "complete", "complete_sum", "count_in_polygons", "covered_by",
    "deflate", "distinct_rows", "drop_first_rows", "drop_scratch", "drop_suffix", "first_rows",
    "fits_in_broadcast",
    "group_constant", "guess_types", "harmonise", "heavy_keys", "keep_inside", "left_join",
    "lenient_sum", "lookup_table", "match_points", "measure_present", "measure_rows",
    "point_columns", "point_problems", "price_index", "recode", "recode_names", "replace_missing",
    "require_unique", "retype", "scratch_path", "settle", "spatial_left_join", "summarise",
    "summarise_through", "tile_polygons", "transmute",
]
