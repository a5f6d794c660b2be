"""Reading and writing corpora."""
from convlens.sources.readers import *  # noqa: F401,F403
from convlens.sources.writers import *  # noqa: F401,F403
