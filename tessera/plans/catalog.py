"""Import every query module so that the registry is complete."""

from . import q_transcripts  # noqa: F401
from . import q_cells  # noqa: F401
from . import q_versions  # noqa: F401
from . import q_raster  # noqa: F401
from . import q_ops  # noqa: F401
from . import q_files  # noqa: F401
from . import q_more  # noqa: F401
from . import q_slides  # noqa: F401
from . import q_blocks  # noqa: F401
from . import q_jobs  # noqa: F401
