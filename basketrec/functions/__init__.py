"""Column-level helpers, all built from JVM-side ``pyspark.sql.functions``."""

from basketrec.functions.hashing import hash_u32, hash_order_key  # noqa: F401
from basketrec.functions.vectors import array_dot, array_magnitude, array_cosine, centroid_cosine  # noqa: F401
from basketrec.functions.indexing import dense_index  # noqa: F401
