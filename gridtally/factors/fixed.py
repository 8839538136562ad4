"""Factor values that must equal the published ones for results to be right."""

from __future__ import annotations

# Services whose storage is solid state.
SSD_SERVICES = """
AmazonDocDB
AmazonDynamoDB
AmazonEFS
AmazonES
AmazonSimpleDB
AmazonSageMaker
AWSIoTAnalytics
AmazonKinesisAnalytics
AmazonMQ
AmazonECS
AmazonLightsail
AmazonNeptune
AmazonFSx
AmazonKinesis
"""

# Endings of usage types billed for solid-state storage.
SSD_USAGE_TYPES = """
VolumeUsage.gp2
VolumeUsage.io2
VolumeUsage.io1
VolumeUsage.gp3
VolumeUsage.piops
GP2-Storage
PIOPS-Storage
Aurora:StorageUsage
Kafka.Storage.GP2
ES:Magnetic-Storage
TimedPITRStorage-ByteHrs
ECS-EC2-GB-Hours
Lambda-GB-Second
Lambda-Edge-GB-Second
RDS:Multi-AZ-StorageUsage
Fargate-GB-Hours
dc2.large
dc2.8xlarge
ra3.xlplus
ra3.4xlarge
ra3.16xlarge
Storage.SSD.50
Storage.MultiAZ:SSD
RDS:GP3-Storage
"""

# Endings of usage types billed for magnetic storage.
HDD_USAGE_TYPES = """
VolumeUsage.st1
VolumeUsage.sc1
VolumeUsage
SnapshotUsage
TimedStorage-ByteHrs
RDS:StorageUsage
GlacierByteHrs
Aurora:BackupUsage
RDS:ChargedBackupUsage
TimedStorage-RRS-ByteHrs
ElastiCache:BackupUsage
BackupUsage
Redshift:PaidSnapshots
TimedStorage-SIA-ByteHrs
EarlyDelete-SIA
TimedStorage-GlacierStaging
TimedStorage-SIA-SmObjects
TimedStorage-GDA-ByteHrs
TimedStorage-GDA-Staging
TimedStorage-ZIA-ByteHrs
TimedStorage-INT-FA-ByteHrs
EarlyDelete-GDA
ProcessedStorage-ByteHrs
EarlyDelete-ZIA
EarlyDelete-ByteHrs
TimedStorage-ZIA-SmObjects
TimedStorage-INT-IA-ByteHrs
EarlyDelete-SIA-SmObjects
EarlyDelete-ZIA-SmObjects
QS-Enterprise-SPICE
TimedBackupStorage-ByteHrs
DurableApplicationBackups
dc1.large
dc1.8xlarge
ds2.xlarge
ds2.8xlarge
EU-TimedStorage-GDA-Staging
BytesDeleted-STANDARD
BytesDeleted-SIA
BytesDeleted-INT
BytesDeleted-GDA
OverwriteBytes-Put-GLACIER
OverwriteBytes-Put-RRS
BackupUsage.MultiAZ
ColdStorage-ByteHrs-EFS
WarmStorage-ByteHrs-EFS
WarmStorage-ByteHrs-DynamoDB
MagneticStore-ByteHrs
ColdStorage-ByteHrs-DynamoDB
WarmStorage-ByteHrs-S3
AMP:MetricStorageByteHrs
TimedStorage-INT-AIA-ByteHrs
TimedStorage-GIR-ByteHrs
"""

# Pricing units that denote stored volume.
STORAGE_UNITS = """
GB-Hours
GB-Mo
GB-Month
GB-Months
GB-Mp
GB-month
"""

# AWS replication factors: rule, copies.
STORAGE_REPLICATION = """
S3,6
S3_ONE_ZONE_REDUCED_REDUNDANCY,2
EC2_EBS_VOLUME,2
EC2_EBS_SNAPSHOT,3
EFS,3
EFS_ONE_ZONE,2
RDS_BACKUP,3
RDS_AURORA,6
RDS_MULTI_AZ,2
DOCUMENT_DB_BACKUP,3
DOCUMENT_DB_STORAGE,2
DYNAMO_DB,2
ECR_STORAGE,3
DOCUMENT_ELASTICACHE_BACKUP,3
SIMPLE_DB,2
DEFAULT,1
"""

# Azure capacity units: unit of measure, GB per unit.
AZURE_STORAGE_UNITS = """
1 GB/Month,1
10 GB/Month,10
100 GB/Month,100
1 TB/Month,1024
"""

# Azure managed disk units: unit of measure, disks per unit.
AZURE_DISK_UNITS = """
1/Month,1
1 /Month,1
"""

# Azure replication factors: rule, copies.
AZURE_REPLICATION = """
STORAGE_LRS,3
STORAGE_ZRS,3
STORAGE_GRS,6
STORAGE_GZRS,6
STORAGE_DISKS,3
DEFAULT,1
"""

# Azure managed disks: SKU, GB, medium.
AZURE_DISKS = """
P1,4,SSD
P2,8,SSD
P3,16,SSD
P4,32,SSD
P6,64,SSD
P10,128,SSD
P15,256,SSD
P20,512,SSD
P30,1024,SSD
P40,2048,SSD
P50,4096,SSD
P60,8192,SSD
P70,16384,SSD
P80,32767,SSD
E1,4,SSD
E2,8,SSD
E3,16,SSD
E4,32,SSD
E6,64,SSD
E10,128,SSD
E15,256,SSD
E20,512,SSD
E30,1024,SSD
E40,2048,SSD
E50,4096,SSD
E60,8192,SSD
E70,16384,SSD
E80,32767,SSD
S4,32,HDD
S6,64,HDD
S10,128,HDD
S15,256,HDD
S20,512,HDD
S30,1024,HDD
S40,2048,HDD
S50,4096,HDD
S60,8192,HDD
S70,16384,HDD
S80,32767,HDD
"""

# GPU power draw: model, idle W, full-load W.
GPU_POWER = """
NVIDIA_K520,26,229
NVIDIA_A10G,18,153
NVIDIA_T4,8,71
NVIDIA_L4,8,72
NVIDIA_L40S,40,350
NVIDIA_TESLA_M60,35,306
NVIDIA_TESLA_K80,35,306
NVIDIA_TESLA_V100,35,306
NVIDIA_A100,46,407
NVIDIA_H100,60,700
NVIDIA_H200,60,700
NVIDIA_B200,100,1000
NVIDIA_TESLA_P4,9,76.5
NVIDIA_TESLA_P100,36,306
AMD_RADEON_PRO_V520,26,229
"""

# AWS instances with GPUs: type, GPU model, GPUs.
GPU_INSTANCES = """
p2.xlarge,NVIDIA_TESLA_K80,1
p2.8xlarge,NVIDIA_TESLA_K80,8
p2.16xlarge,NVIDIA_TESLA_K80,16
p3.2xlarge,NVIDIA_TESLA_V100,1
p3.8xlarge,NVIDIA_TESLA_V100,4
p3.16xlarge,NVIDIA_TESLA_V100,8
p3dn.24xlarge,NVIDIA_TESLA_V100,8
p4d.24xlarge,NVIDIA_A100,8
p4de.24xlarge,NVIDIA_A100,8
p5.4xlarge,NVIDIA_H100,1
p5.48xlarge,NVIDIA_H100,8
p5e.48xlarge,NVIDIA_H200,8
p5en.48xlarge,NVIDIA_H200,8
p6-b200.48xlarge,NVIDIA_B200,8
g2.2xlarge,NVIDIA_K520,1
g2.8xlarge,NVIDIA_K520,4
g3s.xlarge,NVIDIA_TESLA_M60,1
g3.4xlarge,NVIDIA_TESLA_M60,1
g3.8xlarge,NVIDIA_TESLA_M60,2
g3.16xlarge,NVIDIA_TESLA_M60,4
g4dn.xlarge,NVIDIA_T4,1
g4dn.2xlarge,NVIDIA_T4,1
g4dn.4xlarge,NVIDIA_T4,1
g4dn.8xlarge,NVIDIA_T4,1
g4dn.16xlarge,NVIDIA_T4,1
g4dn.12xlarge,NVIDIA_T4,4
g4dn.metal,NVIDIA_T4,8
g4ad.xlarge,AMD_RADEON_PRO_V520,1
g4ad.2xlarge,AMD_RADEON_PRO_V520,1
g4ad.4xlarge,AMD_RADEON_PRO_V520,1
g4ad.8xlarge,AMD_RADEON_PRO_V520,2
g4ad.16xlarge,AMD_RADEON_PRO_V520,4
g5.xlarge,NVIDIA_A10G,1
g5.2xlarge,NVIDIA_A10G,1
g5.4xlarge,NVIDIA_A10G,1
g5.8xlarge,NVIDIA_A10G,1
g5.16xlarge,NVIDIA_A10G,1
g5.12xlarge,NVIDIA_A10G,4
g5.24xlarge,NVIDIA_A10G,4
g5.48xlarge,NVIDIA_A10G,8
g5g.xlarge,NVIDIA_T4,1
g5g.2xlarge,NVIDIA_T4,1
g5g.4xlarge,NVIDIA_T4,1
g5g.8xlarge,NVIDIA_T4,1
g5g.16xlarge,NVIDIA_T4,2
g5g.metal,NVIDIA_T4,2
g6.xlarge,NVIDIA_L4,1
g6.2xlarge,NVIDIA_L4,1
g6.4xlarge,NVIDIA_L4,1
g6.8xlarge,NVIDIA_L4,1
g6.16xlarge,NVIDIA_L4,1
gr6.4xlarge,NVIDIA_L4,1
gr6.8xlarge,NVIDIA_L4,1
g6.12xlarge,NVIDIA_L4,4
g6.24xlarge,NVIDIA_L4,4
g6.48xlarge,NVIDIA_L4,8
g6e.xlarge,NVIDIA_L40S,1
g6e.2xlarge,NVIDIA_L40S,1
g6e.4xlarge,NVIDIA_L40S,1
g6e.8xlarge,NVIDIA_L40S,1
g6e.16xlarge,NVIDIA_L40S,1
g6e.12xlarge,NVIDIA_L40S,4
g6e.24xlarge,NVIDIA_L40S,4
g6e.48xlarge,NVIDIA_L40S,8
"""

# AWS efficiency: place, region or pattern, PUE, WUE.
AWS_PUE_WUE = """
Europe,eu-.+,1.11,0.04
Midde East,me-.+,1.3,
North America,us-.+,1.14,0.13
North America,mx-.+,1.14,
Asia Pacific (excl. China),ap-.+,1.27,0.98
China,cn-.+,1.25,
Africa (Cape Town),af-south-1,1.24,
Asia-Pacific (Tokyo),ap-northeast-1,1.27,0.91
Asia-Pacific (Mumbai),ap-south-1,1.42,
Asia-Pacific (Hyderabad),ap-south-2,1.46,
Asia-Pacific (Singapore),ap-southeast-1,1.32,1.68
Asia-Pacific (Sydney),ap-southeast-2,,0.12
Asia-Pacific (Jakarta),ap-southeast-3,1.4,2.75
Asia-Pacific (Melbourne),ap-southeast-4,,0.02
Canada (Central),ca-central-1,1.19,0.04
Canada (West),ca-west-1,1.17,0.08
China (Ningxia),cn-northwest-1,1.25,
Europe (Frankfurt),eu-central-1,1.35,0.01
Europe (Stockholm),eu-north-1,1.1,0.02
Europe (Spain),eu-south-2,1.09,0.24
Europe (Ireland),eu-west-1,1.11,0.03
Middle East (UAE),me-central-1,1.27,
Middle East (Bahrain),me-south-1,1.33,
South America (Sao Paulo),sa-east-1,1.17,0.23
U.S. East (Northern Virginia),us-east-1,1.15,0.12
U.S. East (Ohio),us-east-2,1.13,0.1
U.S. West (Northern California),us-west-1,1.18,0.51
U.S. West (Oregon),us-west-2,1.12,0.16
Israel,il-central-1,1.3,
"""

# Azure efficiency: place, region or pattern, PUE, WUE.
AZURE_PUE_WUE = """
Australia Central (Canberra),australiacentral,1.28,0.25
Australia Central 2 (Canberra),australiacentral2,1.28,0.25
Australia Southeast (Melbourne),australiasoutheast,1.28,0.25
Australia East (Sydney),australiaeast,1.28,0.25
Austria East (Vienna),austriaeast,1.16,0.03
Belgium Central,belgiumcentral,1.16,0.03
Brazil Southeast (Rio),brazilsoutheast,1.16,0.34
Brazil South (São Paulo),brazilsouth,1.16,0.34
Canada East (Quebec City),canadaeast,1.16,0.34
Canada Central (Toronto),canadacentral,1.16,0.34
Chile Central (Santiago),chilecentral,1.16,0.34
China North (Beijing),chinanorth,1.28,0.25
China North 2 (Beijing),chinanorth2,1.28,0.25
China North 3 (Beijing),chinanorth3,1.28,0.25
East Asia (Hong Kong),eastasia,1.28,0.25
China East 3 (Jiangsu),chinaeast3,1.28,0.25
China East (Shanghai),chinaeast,1.28,0.25
China East 2 (Shanghai),chinaeast2,1.28,0.25
Denmark East (Copenhagen),denmarkeast,1.16,0.03
Finland (Helsinki),finlandcentral,1.16,0.03
France South (Marseille),francesouth,1.16,0.03
France Central (Paris),francecentral,1.16,0.03
Germany North (Berlin),germanynorth,1.16,0.03
Germany West Central (Frankfurt),germanywestcentral,1.16,0.03
Greece Central (Athens),greececentral,1.16,0.03
South India (Chennai),southindia,1.28,0.25
Southcentral (Hyderabad),indiasouthcentral,1.28,0.25
West India (Mumbai),westindia,1.28,0.25
Central India (Pune),centralindia,1.28,0.25
Indonesia Central (Jakarta),indonesiacentral,1.28,0.25
North Europe (Dublin),northeurope,1.16,0.03
Israel Central (Tel Aviv),israelcentral,1.16,0.03
Italy North (Milan),italynorth,1.16,0.03
Japan West (Osaka),japanwest,1.28,0.25
Japan East (Saitama Tokyo),japaneast,1.28,0.25
Malaysia West (Kuala Lumpur),malaysiawest,1.28,0.25
Mexico Central (Querétaro),mexicocentral,1.16,0.34
West Europe (Amsterdam),westeurope,1.16,0.03
New Zealand North (Auckland),newzealandnorth,1.28,0.25
Norway East (Oslo),norwayeast,1.16,0.03
Norway West (Stavanger),norwaywest,1.16,0.03
Poland Central (Warsaw),polandcentral,1.16,0.03
Qatar Central (Doha),qatarcentral,1.16,0.03
Saudi Arabia East,saudiarabiasouthcentral,1.28,0.25
Southeast Asia (Singapore),southeastasia,1.28,0.25
South Africa West (Cape Town),southafricawest,1.16,0.03
South Africa North (Johannesburg),southafricanorth,1.16,0.03
Korea South (Busan),koreasouth,1.28,0.25
Korea Central (Seoul),koreacentral,1.28,0.25
Spain Central (Madrid),spaincentral,1.16,0.03
Sweden Central (Gävle),swedencentral,1.16,0.03
Sweden South (Staffanstorp),swedensouth,1.16,0.03
Switzerland West (Geneva),switzerlandwest,1.16,0.03
Switzerland North (Zürich),switzerlandnorth,1.16,0.03
Taiwan North (Taipei),taiwannorth,1.28,0.25
UAE Central (Abu Dhabi),uaecentral,1.16,0.03
UAE North (Dubai),uaenorth,1.16,0.03
UK West (Cardiff),ukwest,1.16,0.03
UK South (London),uksouth,1.16,0.03
East US 3 (Atlanta),eastus3,1.16,0.34
US Gov Texas,usgovtexas,1.16,0.34
West Central US (Cheyenne),westcentralus,1.16,0.34
North Central US (Chicago),northcentralus,1.16,0.34
Central US (Des Moines),centralus,1.16,0.34
US DoD Central,usdodwest,1.16,0.34
West US 2 (Quincy),westus2,1.16,0.34
US Gov Arizona,usgovarizona,1.16,0.34
West US 3 (Phoenix),westus3,1.16,0.34
East US 2 (Richmond),eastus2,1.16,0.34
US DoD East,usdodeast,1.16,0.34
East US (Ashburn),eastus,1.16,0.34
US Sec East,usseceast,1.16,0.34
South Central US (San Antonio),southcentralus,1.16,0.34
West US (San Francisco),westus,1.16,0.34
US Sec West,ussecwest,1.16,0.34
US Gov Virginia ,usgovvirginia,1.16,0.34
"""

# Grid intensity (CC-BY-4.0, Ember): provider, region, gCO2 per kWh.
CARBON_INTENSITY = """
aws,ap-southeast-4,525.18
aws,ap-southeast-2,525.18
aws,me-south-1,902.24
aws,sa-east-1,109.95
aws,ca-west-1,190.72
aws,ca-central-1,190.72
aws,cn-north-1,525.34
aws,ap-east-1,525.34
aws,cn-northwest-1,525.34
aws,eu-west-3,41.44
aws,eu-central-1,329.65
aws,ap-south-2,679.88
aws,ap-south-1,658.97
aws,ap-southeast-3,680.25
aws,eu-west-1,256.54
aws,il-central-1,492.69
aws,eu-south-1,284.78
aws,ap-northeast-3,477.26
aws,ap-northeast-1,477.26
aws,ap-southeast-1,497.09
aws,af-south-1,699.29
aws,ap-northeast-2,417.06
aws,eu-south-2,153.6
aws,eu-north-1,35.26
aws,eu-central-2,39.22
aws,ap-southeast-7,545.74
aws,me-central-1,467.51
aws,eu-west-2,217.41
aws,us-gov-east-1,479.05
aws,us-east-2,479.05
aws,us-gov-west-1,184.02
aws,us-west-1,177.11
aws,us-west-2,184.02
aws,us-east-1,384.4
aws,ap-southeast-6,92.76
aws,ap-southeast-5,601.97
aws,mx-central-1,474.02
aws,ap-east-2,633.21
gcp,australia-southeast2,525.18
gcp,australia-southeast1,525.18
gcp,europe-west1,149.82
gcp,southamerica-east1,109.95
gcp,northamerica-northeast1,190.72
gcp,northamerica-northeast2,190.72
gcp,southamerica-west1,289.49
gcp,asia-east2,525.34
gcp,europe-north1,57.47
gcp,europe-west9,41.44
gcp,europe-west10,329.65
gcp,europe-west3,329.65
gcp,asia-south1,658.97
gcp,asia-south2,421.04
gcp,asia-southeast2,680.25
gcp,me-west1,492.69
gcp,europe-west8,284.78
gcp,europe-west12,284.78
gcp,asia-northeast2,477.26
gcp,asia-northeast1,477.26
gcp,europe-west4,253.56
gcp,europe-central2,588.6
gcp,me-central1,581.52
gcp,me-central2,691.95
gcp,asia-southeast1,497.09
gcp,africa-south1,699.29
gcp,asia-northeast3,417.06
gcp,europe-southwest1,153.6
gcp,europe-north2,35.26
gcp,europe-west6,39.22
gcp,asia-east1,633.21
gcp,europe-west2,217.41
gcp,us-east1,259.37
gcp,us-east5,479.05
gcp,us-south1,342.52
gcp,us-west4,299.02
gcp,us-west2,177.11
gcp,us-central1,400.49
gcp,us-west3,542.89
gcp,us-west1,184.02
gcp,us-east4,327.17
gcp,northamerica-south1,474.02
gcp,asia-southeast3,545.74
azure,australiacentral,525.18
azure,australiacentral2,525.18
azure,australiasoutheast,525.18
azure,australiaeast,525.18
azure,austriaeast,116.91
azure,belgiumcentral,149.82
azure,brazilsoutheast,109.95
azure,brazilsouth,109.95
azure,canadaeast,190.72
azure,canadacentral,190.72
azure,chilecentral,289.49
azure,chinanorth,525.34
azure,chinanorth2,525.34
azure,chinanorth3,525.34
azure,eastasia,525.34
azure,chinaeast3,525.34
azure,chinaeast,525.34
azure,chinaeast2,525.34
azure,denmarkeast,114.41
azure,finlandcentral,57.47
azure,francesouth,41.44
azure,francecentral,41.44
azure,germanynorth,329.65
azure,germanywestcentral,329.65
azure,greececentral,315.09
azure,southindia,493.19
azure,indiasouthcentral,679.88
azure,westindia,658.97
azure,centralindia,658.97
azure,indonesiacentral,680.25
azure,northeurope,256.54
azure,israelcentral,492.69
azure,italynorth,284.78
azure,japanwest,477.26
azure,japaneast,477.26
azure,malaysiawest,601.97
azure,mexicocentral,474.02
azure,westeurope,253.56
azure,newzealandnorth,92.76
azure,norwayeast,28.11
azure,norwaywest,28.11
azure,polandcentral,588.6
azure,qatarcentral,581.52
azure,saudiarabiasouthcentral,691.95
azure,southeastasia,497.09
azure,southafricawest,699.29
azure,southafricanorth,699.29
azure,koreasouth,417.06
azure,koreacentral,417.06
azure,spaincentral,153.6
azure,swedencentral,35.26
azure,swedensouth,35.26
azure,switzerlandwest,39.22
azure,switzerlandnorth,39.22
azure,taiwannorth,633.21
azure,uaecentral,467.51
azure,uaenorth,467.51
azure,ukwest,217.41
azure,uksouth,217.41
azure,eastus3,317.96
azure,usgovtexas,342.52
azure,westcentralus,539.33
azure,northcentralus,222.41
azure,centralus,275.36
azure,usdodwest,275.36
azure,westus2,124.36
azure,usgovarizona,282.98
azure,westus3,282.98
azure,eastus2,327.17
azure,usdodeast,327.17
azure,eastus,327.17
azure,usseceast,327.17
azure,southcentralus,342.52
azure,westus,177.11
azure,ussecwest,177.11
azure,usgovvirginia,384.4
"""

# Water consumed by electricity generation (WRI): provider, region, litres per kWh.
WATER_CONSUMPTION = """
aws,ap-east-1,6.006471
aws,ap-east-2,1.488631
aws,ap-northeast-1,2.306355
aws,ap-northeast-2,1.887679
aws,ap-northeast-3,2.306355
aws,ap-south-1,3.436844
aws,ap-south-2,3.436844
aws,ap-southeast-2,4.729311
aws,ap-southeast-3,2.255367
aws,ap-southeast-4,4.729311
aws,ap-southeast-5,1.677809
aws,ap-southeast-6,14.968107
aws,ap-southeast-7,2.890221
aws,ca-central-1,8.166262
aws,ca-west-1,8.166262
aws,cn-north-1,6.006471
aws,cn-northwest-1,6.006471
aws,eu-central-1,1.946974
aws,eu-central-2,5.664157
aws,eu-north-1,6.031510
aws,eu-south-1,4.837408
aws,eu-south-2,6.208784
aws,eu-west-1,1.476930
aws,eu-west-2,2.329000
aws,eu-west-3,3.673696
aws,mx-central-1,5.304728
aws,sa-east-1,18.603389
aws,us-east-1,2.312704
aws,us-east-2,2.219776
aws,us-gov-east-1,2.219776
aws,us-gov-west-1,9.482460
aws,us-west-1,5.189329
aws,us-west-2,9.482460
azure,australiacentral,4.729311
azure,australiacentral2,4.729311
azure,australiaeast,4.729311
azure,australiasoutheast,4.729311
azure,austriaeast,5.722182
azure,belgiumcentral,2.619840
azure,brazilsouth,18.603389
azure,brazilsoutheast,18.603389
azure,canadacentral,8.166262
azure,canadaeast,8.166262
azure,centralindia,3.436844
azure,centralus,3.101684
azure,chilecentral,10.522585
azure,chinaeast,6.006471
azure,chinaeast2,6.006471
azure,chinaeast3,6.006471
azure,chinanorth,6.006471
azure,chinanorth2,6.006471
azure,chinanorth3,6.006471
azure,denmarkeast,3.193482
azure,eastasia,6.006471
azure,eastus,2.312704
azure,eastus2,2.366638
azure,eastus3,2.294556
azure,finlandcentral,4.528930
azure,francecentral,3.673696
azure,francesouth,3.673696
azure,germanynorth,1.946974
azure,germanywestcentral,1.946974
azure,greececentral,5.145123
azure,indiasouthcentral,3.436844
azure,indonesiacentral,2.255367
azure,italynorth,4.837408
azure,japaneast,2.306355
azure,japanwest,2.306355
azure,koreacentral,1.887679
azure,koreasouth,1.887679
azure,malaysiawest,1.677809
azure,mexicocentral,5.304728
azure,newzealandnorth,14.968107
azure,northcentralus,2.219776
azure,northeurope,1.476930
azure,norwayeast,6.663363
azure,norwaywest,6.663363
azure,polandcentral,2.513474
azure,southcentralus,1.269599
azure,southindia,3.436844
azure,spaincentral,6.208784
azure,swedencentral,6.031510
azure,swedensouth,6.031510
azure,switzerlandnorth,5.664157
azure,switzerlandwest,5.664157
azure,taiwannorth,1.488631
azure,uksouth,2.329000
azure,ukwest,2.329000
azure,usdodeast,2.366638
azure,usdodwest,3.101684
azure,usgovarizona,4.965618
azure,usgovtexas,1.269599
azure,usgovvirginia,2.312704
azure,usseceast,2.366638
azure,ussecwest,5.189329
azure,westcentralus,2.578146
azure,westeurope,3.433040
azure,westindia,3.436844
azure,westus,5.189329
azure,westus2,9.482460
azure,westus3,4.965618
gcp,asia-east1,1.488631
gcp,asia-east2,6.006471
gcp,asia-northeast1,2.306355
gcp,asia-northeast2,2.306355
gcp,asia-northeast3,1.887679
gcp,asia-south1,3.436844
gcp,asia-south2,3.436844
gcp,asia-southeast2,2.255367
gcp,asia-southeast3,2.890221
gcp,australia-southeast1,4.729311
gcp,australia-southeast2,4.729311
gcp,europe-central2,2.513474
gcp,europe-north1,4.528930
gcp,europe-north2,6.031510
gcp,europe-southwest1,6.208784
gcp,europe-west1,2.619840
gcp,europe-west10,1.946974
gcp,europe-west12,4.837408
gcp,europe-west2,2.329000
gcp,europe-west3,1.946974
gcp,europe-west4,3.433040
gcp,europe-west6,5.664157
gcp,europe-west8,4.837408
gcp,europe-west9,3.673696
gcp,northamerica-northeast1,8.166262
gcp,northamerica-northeast2,8.166262
gcp,northamerica-south1,5.304728
gcp,southamerica-east1,18.603389
gcp,southamerica-west1,10.522585
gcp,us-central1,3.101684
gcp,us-east1,2.294556
gcp,us-east4,2.312704
gcp,us-east5,2.219776
gcp,us-south1,1.269599
gcp,us-west1,9.482460
gcp,us-west2,5.189329
gcp,us-west3,2.578146
gcp,us-west4,4.965618
"""

# Baseline water stress (WRI Aqueduct 4.0): provider, region, category 0 to 4.
WATER_STRESS = """
aws,af-south-1,4
aws,ap-east-1,2
aws,ap-northeast-1,2
aws,ap-northeast-2,2
aws,ap-northeast-3,1
aws,ap-south-1,4
aws,ap-south-2,3
aws,ap-southeast-2,3
aws,ap-southeast-3,2
aws,ap-southeast-4,3
aws,ap-southeast-5,0
aws,ap-southeast-6,0
aws,ap-southeast-7,3
aws,ca-central-1,1
aws,ca-west-1,2
aws,cn-north-1,2
aws,cn-northwest-1,2
aws,eu-central-1,2
aws,eu-central-2,0
aws,eu-north-1,0
aws,eu-south-1,1
aws,eu-south-2,3
aws,eu-west-1,0
aws,eu-west-2,1
aws,eu-west-3,1
aws,il-central-1,4
aws,me-central-1,4
aws,mx-central-1,3
aws,sa-east-1,1
aws,us-east-1,2
aws,us-east-2,1
aws,us-gov-east-1,1
aws,us-gov-west-1,1
aws,us-west-1,4
aws,us-west-2,1
azure,australiacentral,2
azure,australiacentral2,2
azure,australiaeast,3
azure,australiasoutheast,3
azure,austriaeast,0
azure,belgiumcentral,4
azure,brazilsouth,1
azure,brazilsoutheast,0
azure,canadacentral,1
azure,canadaeast,1
azure,centralindia,4
azure,centralus,1
azure,chilecentral,4
azure,chinaeast,3
azure,chinaeast2,3
azure,chinaeast3,2
azure,chinanorth,2
azure,chinanorth2,2
azure,chinanorth3,4
azure,denmarkeast,0
azure,eastasia,2
azure,eastus,2
azure,eastus2,2
azure,eastus3,2
azure,finlandcentral,0
azure,francecentral,1
azure,francesouth,1
azure,germanynorth,2
azure,germanywestcentral,2
azure,greececentral,4
azure,indiasouthcentral,3
azure,indonesiacentral,2
azure,israelcentral,4
azure,italynorth,1
azure,japaneast,2
azure,japanwest,1
azure,koreacentral,2
azure,koreasouth,2
azure,malaysiawest,0
azure,mexicocentral,3
azure,newzealandnorth,0
azure,northcentralus,2
azure,northeurope,0
azure,norwayeast,0
azure,norwaywest,0
azure,polandcentral,1
azure,qatarcentral,4
azure,saudiarabiasouthcentral,4
azure,southafricanorth,4
azure,southafricawest,4
azure,southcentralus,3
azure,southindia,4
azure,spaincentral,4
azure,swedencentral,0
azure,swedensouth,0
azure,switzerlandnorth,0
azure,switzerlandwest,0
azure,uaecentral,4
azure,uaenorth,4
azure,uksouth,1
azure,ukwest,1
azure,usdodeast,2
azure,usdodwest,1
azure,usgovarizona,4
azure,usgovtexas,3
azure,usgovvirginia,0
azure,usseceast,2
azure,ussecwest,4
azure,westcentralus,3
azure,westeurope,0
azure,westindia,4
azure,westus,4
azure,westus2,1
azure,westus3,4
gcp,africa-south1,4
gcp,asia-east2,2
gcp,asia-northeast1,2
gcp,asia-northeast2,1
gcp,asia-northeast3,2
gcp,asia-south1,4
gcp,asia-south2,4
gcp,asia-southeast2,2
gcp,asia-southeast3,3
gcp,australia-southeast1,3
gcp,australia-southeast2,3
gcp,europe-central2,1
gcp,europe-north1,0
gcp,europe-north2,0
gcp,europe-southwest1,4
gcp,europe-west1,4
gcp,europe-west10,2
gcp,europe-west12,2
gcp,europe-west2,1
gcp,europe-west3,2
gcp,europe-west4,1
gcp,europe-west6,0
gcp,europe-west8,1
gcp,europe-west9,1
gcp,me-central1,4
gcp,me-central2,4
gcp,me-west1,4
gcp,northamerica-northeast1,1
gcp,northamerica-northeast2,1
gcp,northamerica-south1,3
gcp,southamerica-east1,1
gcp,southamerica-west1,4
gcp,us-central1,4
gcp,us-east1,2
gcp,us-east4,2
gcp,us-east5,1
gcp,us-south1,3
gcp,us-west1,1
gcp,us-west2,4
gcp,us-west3,3
gcp,us-west4,3
"""

# Labels in usage types: label, model provider, model.
TOKEN_MODEL_LABELS = """
Mistral7B,huggingface_hub,mistralai/Mistral-7B-v0.3
MistralLarge,mistralai,mistral-large-latest
Mixtral8x7B,huggingface_hub,mistralai/Mixtral-8x7B-Instruct-v0.1
"""

# Instance family, Arm family that replaces it.
ARM_FAMILIES = """
m5,m6g
m5a,m6g
m5d,m6gd
c5,c6g
c5a,c6g
c5d,c6gd
r5,r6g
r5a,r6g
r5d,r6gd
x1,x2g
i3,i4g
"""

# Comparisons: metric, slot, flavour (blank = every one), unit, amount of the metric per unit.
EQUIVALENCES = """
emissions,1,,km in a family car,0.170
emissions,2,Everyday,flights,500
emissions,2,Tech,hours of video streaming,0.036
emissions,2,Nature,tree-years to absorb it,21
energy,1,,homes powered for a year,3500
energy,2,Everyday,cups of tea boiled,0.03
energy,2,Tech,smartphone charges,0.012
energy,2,Nature,solar-panel days,1.5
water,1,,Olympic swimming pools,2500000
water,2,Everyday,bathtubs filled,150
water,2,Tech,washing machine cycles,50
water,2,Nature,m²-years of rainfall,750
"""

# US states and the grid subregion they count towards (Virginia is split).
STATE_GRIDS = """
Alabama,SRSO
Alaska,AKGD
Arizona,AZNM
Arkansas,SRMV
California,CAMX
Colorado,RMPA
Connecticut,NEWE
Delaware,RFCE
District of Columbia,RFCE
Florida,FRCC
Georgia,SRSO
Hawaii,HIOA
Idaho,NWPP
Illinois,RFCW
Indiana,RFCW
Iowa,MROW
Kansas,SPNO
Kentucky,SRMW
Louisiana,SRMV
Maine,NEWE
Maryland,RFCE
Massachusetts,NEWE
Michigan,RFCM
Minnesota,MROW
Mississippi,SRMV
Missouri,SRMW
Montana,NWPP
Nebraska,MROW
Nevada,AZNM
New Hampshire,NEWE
New Jersey,RFCE
New Mexico,AZNM
New York,NYUP
North Carolina,SRVC
North Dakota,MROW
Ohio,RFCW
Oklahoma,SPSO
Oregon,NWPP
Pennsylvania,RFCE
Rhode Island,NEWE
South Carolina,SRSO
South Dakota,MROW
Tennessee,SRTV
Texas,ERCT
Utah,RMPA
Vermont,NEWE
Washington,NWPP
West Virginia,RFCW
Wisconsin,MROE
Wyoming,RMPA
"""

# Region corrections: provider, action, source, target, latitude, longitude, metro area, name.
REGION_FIXES = """
aws,move,ap-east-2,ap-southeast-6
aws,promote,Malaysia,ap-southeast-5
aws,promote,AWS Mexico central,mx-central-1
aws,promote,Asia Pacific (Taipei),ap-east-2
aws,move,us-west-1,us-west-2
aws,move,us-west-2,us-west-1
aws,edit,us-east-1,,39.043757,-77.487442,Ashburn
aws,edit,cn-northwest-1,,38.487193,106.230909,Yinchuan
aws,edit,ca-central-1,,45.501690,-73.567253
gcp,promote,Mexico,northamerica-south1
gcp,promote,Thailand,asia-southeast3
azure,edit,eastus,,39.043757,-77.487442,Ashburn,East US (Ashburn)
"""
