"""DuckDB SQL that states each registered query independently of the Spark code."""
