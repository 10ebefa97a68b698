"""Height rasters of buildings as compressed numpy archives: one file a building, arrays and their place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gablestone.operators.shared import cut, uri

#: The names that files use for what cells are called here.
OBSERVED = {"elevation_m": "height", "point_count": "points"}
NORMALIZED = {"height_m": "above_ground", "terrain_elevation_m": "elevation"}


def read(spark: SparkSession, path: str, names: dict[str, str] = OBSERVED) -> DataFrame:
    """(building_id, row, col, the columns of names, valid, ox, oy, resolution, crs, error): the footprint's cells of each file, row 0
    the southern one; NaN is NULL. A file that cannot be read is one row with an error."""
    values = list(names.values())
    columns = ["building_id", "row", "col", *values, "valid", "ox", "oy", "resolution", "crs", "error"]

    def run(batches):
        import io

        import numpy as np
        import pandas as pd

        for pdf in batches:
            for path, content in pdf.itertuples(index=False):
                building = path.rpartition("/")[2].removesuffix(".npz")
                try:
                    with np.load(io.BytesIO(content), allow_pickle=False) as data:
                        row, col = np.nonzero(data["footprint_mask"])
                        own = {n: data[k][row, col].astype(float) for k, n in names.items()}
                        origin = data["origin"]
                        rows = pd.DataFrame({"building_id": building, "row": row, "col": col, **own, "valid": data["valid_mask"][row, col], "ox": float(origin[0]), "oy": float(origin[1]), "resolution": float(data["resolution_m"]), "crs": str(data["crs"]), "error": None})
                except Exception as e:
                    rows = pd.DataFrame([{"building_id": building, "error": f"{type(e).__name__}: {e}"}])
                rows = rows.reindex(columns=columns).astype({"row": "Int64", "col": "Int64", "valid": "boolean", "building_id": object, "crs": object, "error": object})
                yield rows

    schema = f"building_id string, row long, col long, {', '.join(f'{v} double' for v in values)}, valid boolean, ox double, oy double, resolution double, crs string, error string"
    out = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, schema)
    return out.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in values else F.col(c) for c in columns])


def write(cells: DataFrame, path: str, names: dict[str, str] = OBSERVED, crs: str = "EPSG:25830", **constants) -> DataFrame:
    """path/<building_id>.npz of the footprint cells (building_id, row, col, the columns of names, ox, oy, resolution) of each building;
    (building_id, file). A building's grid is one value. constants (height_percentile, terrain_source) are stored as they are."""
    base = uri(path)
    kind = dict(cells.dtypes)["building_id"]

    def save(pdf):
        import io
        import os
        import uuid

        import numpy as np
        import pandas as pd
        from pyarrow import fs

        shape = int(pdf["row"].max()) + 1, int(pdf["col"].max()) + 1
        at = pdf["row"].to_numpy(int), pdf["col"].to_numpy(int)
        arrays = {}
        for k, n in names.items():
            arrays[k] = np.zeros(shape, np.int64) if k == "point_count" else np.full(shape, np.nan)
            arrays[k][at] = pdf[n].fillna(0 if k == "point_count" else np.nan)
        mask, valid = np.zeros(shape, bool), np.zeros(shape, bool)
        mask[at], valid[at] = True, pdf[next(iter(names.values()))].notna()
        first = pdf.iloc[0]
        buffer = io.BytesIO()
        np.savez_compressed(buffer, **arrays, footprint_mask=mask, valid_mask=valid, origin=np.array([first["ox"], first["oy"]], float), resolution_m=np.array(float(first["resolution"])), crs=np.array(crs), **{k: np.array(v) for k, v in constants.items()})
        file = f"{base}/{first['building_id']}.npz"
        where, final = fs.FileSystem.from_uri(file)
        where.create_dir(os.path.dirname(final), recursive=True)
        own = f"{final}.{uuid.uuid4().hex}.tmp"
        with where.open_output_stream(own) as f:
            f.write(buffer.getvalue())
        where.move(own, final)
        return pd.DataFrame({"building_id": [first["building_id"]], "file": [file]})

    own = ["building_id", "row", "col", *names.values(), "ox", "oy", "resolution"]
    return cut(cells.select(*own).groupBy("building_id").applyInPandas(save, f"building_id {kind}, file string"))
