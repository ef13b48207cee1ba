from feedloom.sinks.datasets import dated_target, load_manifest, write_dataset, write_watermark
from feedloom.sinks.publish import publish, stage
from feedloom.sinks.releases import Releases

__all__ = ["Releases", "dated_target", "load_manifest", "publish", "stage", "write_dataset", "write_watermark"]
