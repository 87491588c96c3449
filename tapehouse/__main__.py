from tapehouse.cli import main

main()
