"""Query registrations, grouped by operator family."""

from . import q_localstats, q_grid, q_coords, q_pointwise, q_stencil, q_filters, q_blocks, q_jobs, q_udf, q_blockops, q_align, q_store  # noqa: F401
