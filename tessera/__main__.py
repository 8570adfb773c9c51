"""``python -m tessera ...`` runs the job command line."""

from .cli import main

raise SystemExit(main())
