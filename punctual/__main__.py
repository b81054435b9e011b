from punctual.jobs.cli import main

main()
