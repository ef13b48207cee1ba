from feedloom.functions import compare, dates, names, text

__all__ = ["compare", "dates", "names", "text"]
