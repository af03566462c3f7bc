import sys

from figcurate.cli import main

sys.exit(main())
