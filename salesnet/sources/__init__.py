from salesnet.sources.star import Star, load_star, load_star_tables, write_star, write_star_tables
from salesnet.sources.tpch import tpch_star
from salesnet.sources.sinks import export_csv

__all__ = ["Star", "load_star", "load_star_tables", "write_star", "write_star_tables", "tpch_star", "export_csv"]
