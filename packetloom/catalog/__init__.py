"""Queries over the sample tables with the DuckDB SQL they are compared with."""
