"""DuckDB SQL that states independently what each registered query must return."""
