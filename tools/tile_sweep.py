"""The downsample -> rotate -> uint8 plane chain (J5) at target block sizes 4, 8, 16, 32.

    python tools/tile_sweep.py [sf_dir] [plane_size]

Prints one JSON line with seconds per tile size (3 rounds, best kept) and
whether every tile size gave the same plane (it must: tiling only changes how
the work is split, never the result).
"""

from __future__ import annotations

import hashlib
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    from tessera import jobs as J
    from tessera.operators import blocks as B
    from tessera.session import get_spark, scratch_dir
    from tessera.sources import chunked as CH
    from tessera.sources import fixtures as fx

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    size = int(sys.argv[2]) if len(sys.argv) > 2 else 128
    spark = get_spark("local[8]", 16, app_name="tessera-tiles")
    root = scratch_dir(spark, "tiles")
    CH.save_blocks(B.from_voxels(fx.embedding_u16(spark, sf_dir), (64, 64, 1)), root, "emb", "n5", "raw")
    times, digests = {}, {}
    for rnd in range(3):
        for t in (4, 8, 16, 32):
            t0 = time.time()
            pdf = J.view_plane(spark, root, "emb", (size, size, 1), (t, t, 1)).df.toPandas()
            dt = time.time() - t0
            times[t] = min(times.get(t, dt), dt)
            pdf = pdf.sort_values(["z", "y", "x"])
            digests[t] = hashlib.sha1(pdf[["x", "y", "z", "v"]].to_numpy().tobytes()).hexdigest()
    print(json.dumps({"plane": [size, size, 1], "seconds": {str(k): round(v, 3) for k, v in times.items()},
                      "same_result": len(set(digests.values())) == 1}))


if __name__ == "__main__":
    main()
