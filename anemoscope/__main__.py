from anemoscope.plans.jobs import main

main()
