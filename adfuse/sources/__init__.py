from adfuse.sources.cache import TableCache
from adfuse.sources.channels import CHANNELS, FACEBOOK, GOOGLE, TIKTOK
from adfuse.sources.files import file_states, fingerprint
from adfuse.sources.readers import read_feed, rejected_rows, type_by_name
from adfuse.sources.sinks import Stored, export_csv, materialize, read_csv_typed, store
from adfuse.sources.spec import FeedSpec
from adfuse.sources.storage import checkpoint_root, remove_scratch, scratch_path

__all__ = [n for n in dir() if not n.startswith("_")]
