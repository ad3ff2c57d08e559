"""Matrix kernels over array columns, run on Arrow batches.

The kernels are nested functions on purpose: they travel to the executors by value, so the
package itself need not be installed there.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_BLOCK = 2048
VECTORS_PER_BLOCK = 1024


def _matrix():
    def matrix(column, dim):
        import numpy as np

        values = column.flatten()
        if column.null_count or values.null_count or len(values) != len(column) * dim:
            raise ValueError(f"every feature array must hold {dim} numbers")
        return np.asarray(values, dtype=float).reshape(-1, dim)

    return matrix


def skipping_nulls(kernel):
    """A kernel over the rows that have features; the others give null. So a row that is not meant for a model costs nothing."""

    def run(column):
        import numpy as np
        import pyarrow as pa

        if not column.null_count:
            return kernel(column)
        there = np.asarray(column.is_valid())
        place = pa.array(np.cumsum(there) - 1, mask=~there)
        return kernel(column.filter(pa.array(there))).take(place)

    return run


def rbf_margin(features: Column, path: str, dim: int, gamma: float, rho: float, held_bytes: int = 256 << 20) -> Column:
    """sum_i coef_i * exp(-gamma * |x - v_i|^2) - rho for vectors in the files under ``path``, in the order of their names.

    A task reads the files block by block. Blocks of up to ``held_bytes`` stay in its memory for its next batches of
    rows; what goes beyond is read again. The sums are the same either way.
    """
    matrix, row_block, vector_block = _matrix(), ROWS_PER_BLOCK, VECTORS_PER_BLOCK
    held: list = []
    state = {"whole": False, "bytes": 0}

    skip = skipping_nulls

    @F.arrow_udf("double")
    def margin(column):
        return skip(sums)(column)

    def sums(column):
        import numpy as np
        import pyarrow as pa
        import pyarrow.dataset as ds
        from pyarrow.fs import FileSelector, FileSystem

        def blocks():
            yield from held
            if state["whole"]:
                return
            fs, folder = FileSystem.from_uri(path)
            names = sorted(f.path for f in fs.get_file_info(FileSelector(folder)) if f.path.endswith(".parquet"))
            done = 0
            for name in names:
                for batch in ds.dataset(name, filesystem=fs, format="parquet").to_batches(columns=["coef", "vector"], batch_size=vector_block):
                    done += 1
                    if batch.num_rows == 0 or done <= state.get("read", 0):
                        continue
                    coefs = np.array(batch.column(0), dtype=float)
                    block = np.array(batch.column(1).flatten(), dtype=float).reshape(-1, dim)
                    if state["bytes"] + block.nbytes <= held_bytes:
                        held.append((coefs, block))
                        state["bytes"] += block.nbytes
                        state["read"] = done
                    else:
                        state["bytes"] = held_bytes  # later blocks are not held either, so the order stays
                    yield coefs, block
            state["whole"] = state.get("read", 0) == done

        x = matrix(column, dim)
        out = np.full(len(x), -rho)
        for coefs, block in blocks():
            for r in range(0, len(x), row_block):
                rows = x[r : r + row_block]
                dist = (rows**2).sum(1)[:, None] + (block**2).sum(1)[None, :] - 2.0 * rows @ block.T
                out[r : r + row_block] += np.exp(-gamma * np.maximum(dist, 0.0)) @ coefs
        return pa.array(out)

    return margin(features)


def nearest(features: Column, centers: np.ndarray) -> Column:
    """Index of the closest centre, squared euclidean, lowest index on ties."""
    matrix, row_block = _matrix(), ROWS_PER_BLOCK
    centers = np.asarray(centers, float)

    @F.arrow_udf("int")
    def index(column):
        import numpy as np
        import pyarrow as pa

        dim = centers.shape[1]
        x = matrix(column, dim)
        out = np.empty(len(x), dtype=np.int32)
        for r in range(0, len(x), row_block):
            rows = x[r : r + row_block]
            dist = np.stack([((rows - c) ** 2).sum(1) for c in centers], axis=1)
            out[r : r + row_block] = dist.argmin(1)
        return pa.array(out, type=pa.int32())

    return index(features)


def kernel_sums(rows: DataFrame, marks: np.ndarray, gamma: float, points: np.ndarray | None = None) -> np.ndarray:
    """Sums over all rows (``x`` array, ``label`` 0 or 1) of what a hinge loss on kernel values k_i = exp(-gamma |x - m_i|^2) needs.

    Without ``points``: the sums of k_i k_j (upper triangle) and of k_i, and the number of rows. Each column of ``points`` is a weight for
    every landmark and an intercept; with them: for each column the loss, for each weight and column the gradient, for each
    column that of the intercept. The kernel values live in a task for one block of rows and are never kept: a row has few
    numbers and as many values as there are landmarks.
    """
    # a block's kernel values stay in the cache of a core
    matrix, row_block = _matrix(), ROWS_PER_BLOCK // 8
    marks = np.asarray(marks, float)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        total, corner = 0.0, np.triu_indices(len(marks))
        for batch in batches:
            x, label = matrix(batch.column(0), marks.shape[1]), np.asarray(batch.column(1).to_numpy(zero_copy_only=False), float)
            if not np.isfinite(x).all() or not np.isin(label, (0.0, 1.0)).all():
                raise ValueError("features must be finite numbers, labels 0 or 1")
            for r in range(0, len(x), row_block):
                some, sign = x[r : r + row_block], 2.0 * label[r : r + row_block, None] - 1.0
                k = some @ (2.0 * gamma * marks.T)
                k -= gamma * (some**2).sum(1)[:, None]
                k -= gamma * (marks**2).sum(1)
                np.exp(np.minimum(k, 0.0, out=k), out=k)
                if points is None:
                    part = [(k.T @ k)[corner], k.sum(0), [len(k)]]
                else:
                    margin = sign * (k @ points[:-1] + points[-1])
                    slope = np.where(margin < 1.0, -sign, 0.0)
                    part = [np.maximum(1.0 - margin, 0.0).sum(0), (k.T @ slope).ravel(), slope.sum(0)]
                total = total + np.concatenate(part)
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    # partitions come in their order, so the sums do not depend on which task ends first
    parts = [np.frombuffer(r.sums) for r in rows.select("x", "label").mapInArrow(run, "sums binary").collect()]
    return np.sum(parts, axis=0)
