from epiledger.plans.reports import main

main()
