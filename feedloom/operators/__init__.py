from feedloom.operators import alerts, controls, documents, feeds, filesets, gates, joins, ordering, tables, versions

__all__ = ["alerts", "controls", "documents", "feeds", "filesets", "gates", "joins", "ordering", "tables", "versions"]
