import sys

from .pipeline.run import main

sys.exit(main())
