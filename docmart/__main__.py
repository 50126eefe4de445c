from .streaming.jobs import main

main()
