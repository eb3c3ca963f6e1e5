"""Registered queries with the DuckDB SQL that checks them."""
