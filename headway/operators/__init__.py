"""Operators: ``op(df, *, params) -> DataFrame``, lazy, without collects or Python UDFs."""
