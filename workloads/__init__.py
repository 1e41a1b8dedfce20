"""Runs of the library on the generated test tables, with the same result in DuckDB SQL."""
