"""geonest: Spark-native location ELT and news ingestion operators.

Every public function takes and returns DataFrames; nothing is created or
stopped at import time.
"""

__version__ = "0.1.0"
