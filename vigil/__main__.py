import sys

from vigil.cli import main

sys.exit(main())
