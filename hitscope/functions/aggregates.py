from pyspark.sql import Column, functions as F


def exact_mean(number: Column) -> Column:
    """Mean of a BIGINT column from an exact sum.

    ``avg`` adds doubles, so past 2**53 its last digits depend on the order in
    which partitions arrive. The sum of 38 digits does not, and holds 10**19 of
    the largest values there are. It is rounded once, when it is divided.
    """
    return F.sum(number.cast("decimal(28,0)")).cast("double") / F.count(number)
