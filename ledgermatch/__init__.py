"""ledgermatch: prove that one table can replace another, on Spark.

Every check is a lazy DataFrame built from DataFrame/SQL operators; only
summary rows and bounded samples ever reach the driver.
"""

__version__ = "0.1.0"
