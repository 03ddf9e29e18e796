"""tessera: user-level analytics operators on Spark DataFrames.

Every operator is a function ``DataFrame(s) + parameters -> DataFrame`` built
from the DataFrame / SQL API, so Catalyst plans it and it runs unchanged on a
laptop (``local[*]``) or a large cluster.
"""

__version__ = "0.1.0"
