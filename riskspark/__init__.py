"""riskspark: behavioural-risk analytics as Spark DataFrame operators.

Every public operator is a plain ``DataFrame -> DataFrame`` function (fitted
operators return ``(DataFrame, state DataFrame)``).  Column names default to
the canonical transaction schema (``uid``, ``TransactionDT``,
``TransactionID`` ...) and can be overridden by keyword.
"""

__version__ = "0.1.0"
