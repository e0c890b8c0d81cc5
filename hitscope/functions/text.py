from pyspark.sql import Column, functions as F


def two_decimals(number: Column) -> Column:
    """Text with two decimals and no thousands mark, for display only.

    Rounds the exact binary value, ties to even; ``printf`` would round the
    shortest decimal form half up and give 2.68 for 2.675.
    """
    # F.format_number takes a digit count only; the SQL form also takes a pattern.
    return F.call_function("format_number", number, F.lit("0.00"))
