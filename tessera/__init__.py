"""tessera: n-dimensional volumes as Spark DataFrames.

Voxel form (``x, y, z, v``) for relational operators and SQL checks; block
form (grid keys + binary payload) for scale.  See README.md.
"""

from .volume import Volume, VolumeMeta, DTYPES  # noqa: F401
