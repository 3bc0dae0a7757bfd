"""diffloom: Spark-native analytics for code-change corpora.

Pull requests, issues, patches, test logs, predictions and retrieval corpora are plain
DataFrames; every operator is a DataFrame -> DataFrame (or Column -> Column) function built
from Spark SQL expressions, so Catalyst plans and Tungsten executes all of it.
"""

__version__ = "0.1.0"
