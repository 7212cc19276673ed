"""DuckDB SQL oracles: independent text for every registered query."""
