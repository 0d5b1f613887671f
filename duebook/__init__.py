"""Daily close of a credit-card portfolio as Spark DataFrame operators."""
