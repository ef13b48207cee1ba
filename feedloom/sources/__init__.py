from feedloom.sources import archives, files, jdbc

__all__ = ["archives", "files", "jdbc"]
