"""Types of money columns.

Raw text is typed with ``try_cast``: under ANSI mode a plain cast of malformed
text aborts the whole query, the ``try_`` form returns NULL so the row reaches
the quality rules and the quarantine.
"""

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
