from envtrack.cli import main

raise SystemExit(main())
